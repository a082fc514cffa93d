"""Queries of corpus analytics, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, numbers, text
from ..operators import corpus, relational, versions
from .tables import table


def _records(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "tool_records")


def _events(s: SparkSession, d: str) -> DataFrame:
    return corpus.delivered_once(table(s, d, "container_events"))


def _sources(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "source_mappings")


_EVENTS = "(SELECT DISTINCT * FROM container_events)"
_STRIP = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
_KEY = r"regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '', 'g')"


def event_status_frequency(s, d):  # noqa: ANN001, ANN201
    return relational.ranked_frequencies(_events(s, d), "status", top=100)


def event_counters(s, d):  # noqa: ANN001, ANN201
    candidates = corpus.image_candidates(_records(s, d)).select("image", "status")
    return corpus.container_summary(_events(s, d), candidates)


def help_coverage(s, d):  # noqa: ANN001, ANN201
    return corpus.help_coverage(_records(s, d), _events(s, d))


def record_event_flags(s, d):  # noqa: ANN001, ANN201
    """Of each record with events: any help, any failure, first and last status."""
    e = _events(s, d).where("pos IS NOT NULL")
    return e.groupBy("pos").agg(F.count("*").alias("events"), F.bool_or(F.col("status") == "help").alias("helped"), F.bool_or(F.col("status").isin("failed", "container-command-missing")).alias("failed"), F.min_by("status", "event_id").alias("first_status"), F.max_by("status", "event_id").alias("last_status"))


def source_status_counts(s, d):  # noqa: ANN001, ANN201
    return relational.frequencies(_sources(s, d).withColumn("source_status", corpus.source_status()), "source_status")


def source_category_counts(s, d):  # noqa: ANN001, ANN201
    m = _sources(s, d).withColumn("source_status", corpus.source_status()).where(~corpus.usable("source_status"))
    return relational.frequencies(m.withColumn("category", corpus.source_category()), "source_status", "category")


def source_coverage(s, d):  # noqa: ANN001, ANN201
    """Records by whether any of their mappings is usable, binary, a provider's or in error; records without mappings count too."""
    r = _records(s, d).select("pos")
    m = _sources(s, d).withColumn("source_status", corpus.source_status())
    per = m.groupBy("pos").agg(F.bool_or(corpus.usable("source_status")).alias("usable"), F.bool_or(F.col("source_status") == "provider_source").alias("provider"), F.bool_or(F.col("source_status") == "source_error").alias("error"))
    j = r.join(per, "pos", "left")
    return j.agg(F.count("*").alias("records"), F.count_if(F.col("usable").isNull()).alias("unmapped"), F.count_if("usable").alias("usable"), F.count_if("provider").alias("provider"), F.count_if("error").alias("error"))


def event_categories(s, d):  # noqa: ANN001, ANN201
    e = _events(s, d).where(F.col("status").isin(*corpus.ISSUE_STATUSES)).withColumn("category", corpus.event_category())
    return relational.frequencies(e, "status", "category")


def _facts(s, d) -> DataFrame:  # noqa: ANN001
    return corpus.failure_facts(_records(s, d), _events(s, d), _sources(s, d))


def failure_facts(s, d):  # noqa: ANN001, ANN201
    return _facts(s, d).select("pos", "kind", "status", "category", "severity", "seq")


def failure_inventory(s, d):  # noqa: ANN001, ANN201
    """Counts by category, by status and by both, in one pass of grouping sets."""
    f = _facts(s, d)
    return f.groupingSets([[F.col("category")], [F.col("status")], [F.col("category"), F.col("status")]], F.col("category"), F.col("status")).agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "hard").alias("hard"))


def failure_packages(s, d):  # noqa: ANN001, ANN201
    """The 50 packages with most issues."""
    named = _facts(s, d).join(_records(s, d).select("pos", text.filled("package_id").alias("package_id")), "pos").where("package_id <> ''")
    return relational.ranked_frequencies(named, "package_id", top=50)


def failure_samples(s, d):  # noqa: ANN001, ANN201
    """The first ten source issues of each category; ``failure_samples_all`` has those of all kinds."""
    return relational.first_n(_facts(s, d).where("kind = 'source'").select("category", "pos", "seq"), ["category"], [F.col("pos"), F.col("seq")], 10).select("category", "pos", "seq", "place")


def failure_samples_all(s, d):  # noqa: ANN001, ANN201
    """The first ten issues of each category, of container events, sources and coverage alike."""
    f = _facts(s, d).select("category", "pos", "kind", "seq")
    return relational.first_n(f, ["category"], [F.col("pos"), F.col("kind"), F.col("seq")], 10).select("category", "pos", "kind", "seq", "place")


def failure_wrappers(s, d):  # noqa: ANN001, ANN201
    w = corpus.wrapper_rollup(_facts(s, d), _records(s, d))
    return w.select("wrapper", "package_id", "tool_id", F.array_join("categories", ",").alias("categories"), F.array_join("statuses", ",").alias("statuses"), "severity")


def retry_manifest(s, d):  # noqa: ANN001, ANN201
    w = corpus.wrapper_rollup(_facts(s, d).where(corpus.retryable()), _records(s, d))
    return w.groupBy("severity").agg(F.count("*").alias("wrappers"), F.sum(F.size("categories")).alias("categories"))


_CHECKOUT, _URL, _ERR = _STRIP.format("source_checkout"), _STRIP.format("source_url"), _STRIP.format("source_error")
_SRC_STATUS = rf"""CASE WHEN lower(trim(source_channel)) = 'runtime' AND {_CHECKOUT} = '' THEN 'source_not_applicable'
    WHEN {_CHECKOUT} <> '' AND source_confidence = 'weak' THEN 'weak_source'
    WHEN lower(trim(source_channel)) = 'provider' THEN 'provider_source'
    WHEN {_ERR} <> '' THEN 'source_error'
    WHEN {_CHECKOUT} <> '' AND regexp_matches(lower({_CHECKOUT}), '\.(jar|whl|exe|so|dll|dylib|bin|class|egg)$') THEN 'binary_artifact'
    WHEN {_CHECKOUT} <> '' THEN 'usable_source' WHEN {_URL} = '' THEN 'blank_source_url' ELSE 'missing_checkout' END"""
_USABLE = "(st IN ('usable_source', 'provider_source', 'source_not_applicable') OR st LIKE '%\\_fallback' ESCAPE '\\')"
_LOW = "lower(concat_ws(chr(10), source_error, source_url))"
_SRC_CAT = rf"""CASE WHEN st = 'binary_artifact' THEN 'binary_artifact' WHEN st = 'weak_source' THEN 'weak_source_version'
    WHEN {_ERR} = 'binary_artifact_no_source' THEN 'binary_artifact_no_source'
    WHEN {_LOW} LIKE '%source download exceeds configured maximum%' THEN 'source_download_too_large'
    WHEN {_LOW} LIKE '%fatal: path ''recipes/%' AND {_LOW} LIKE '%does not exist%' THEN 'recipe_not_found'
    WHEN {_LOW} LIKE '%404%' OR {_LOW} LIKE '%not found%' THEN 'source_404'
    WHEN contains({_LOW}, '{{{{') OR contains({_LOW}, '{{%') OR contains({_LOW}, 'undefined') THEN 'source_template_unresolved'
    WHEN st IN ('source_error', 'missing_checkout', 'blank_source_url') THEN 'source_unavailable' ELSE st END"""
_OUT = "lower(concat_ws(chr(10), error_text, stderr, stdout))"
_ALL = f"concat_ws(chr(10), lower(coalesce(command, '')), {_OUT})"
_FIRST = r"coalesce(nullif(" + _STRIP.format("primary_command") + r", ''), regexp_extract(coalesce(command, ''), '^\s*(\S+)', 1))"
_IS_HELP = rf"""(regexp_matches({_OUT}, 'usage:|options:|optional arguments|--help|commands:|available analysis command line options|available command line options|for more information about a specific command|commandname\(help\)')
    OR regexp_matches({_OUT}, '(?m)^\s*(usage|options?|commands?)\s*:') OR (regexp_matches({_OUT}, '(?m)^\s*synopsis\s*$') AND regexp_matches({_OUT}, '(?m)^\s*(options?|arguments?|parameters?)\s*$')))"""
_EV_CAT = rf"""CASE WHEN status IN ('help-degraded', 'usage-degraded') THEN 'usable_nonzero_help'
    WHEN status = 'api-validation-failed' THEN 'api_import_failure'
    WHEN status = 'prepare-failed' AND ({_ALL} LIKE '%timed out%' OR coalesce(returncode, 0) = 124) THEN 'container_prepare_timeout'
    WHEN status = 'prepare-failed' THEN 'container_prepare_failed'
    WHEN coalesce(command, '') LIKE '%python -m %' AND status = 'container-command-missing' THEN 'missing_executable'
    WHEN regexp_matches(coalesce(command, ''), '[${{]|__tool_directory__') THEN 'unresolved_template'
    WHEN regexp_matches({_OUT}, 'cannot open shared object file|error while loading shared libraries') THEN 'runtime_dependency_missing'
    WHEN NOT {_IS_HELP} AND {_OUT} LIKE '%traceback%' AND {_OUT} LIKE '%indexerror: list index out of range%' AND contains({_OUT}, 'sys.argv[') THEN 'bad_probe_variant'
    WHEN regexp_matches({_OUT}, 'traceback|modulenotfounderror|importerror') THEN 'api_import_failure'
    WHEN regexp_matches({_ALL}, 'can''t open file|cannot open file|fail to open file ''help''') THEN 'bad_probe_variant'
    WHEN status = 'container-command-missing' THEN 'missing_executable'
    WHEN status = 'nonhelp' AND {_OUT} LIKE '%version%' AND regexp_matches({_OUT}, 'can''t open the file|cannot open file') AND regexp_matches({_OUT}, 'exiting|error\(s\)|required') THEN 'usable_nonhelp_output'
    WHEN status = 'nonhelp' AND regexp_matches(lower({_FIRST}), '\.(py|r|pl|sh|bash|rb|js)$') THEN 'helper_script_probe'
    WHEN status IN ('nonhelp', 'failed') THEN 'bad_probe_variant' ELSE 'terminal_unknown' END"""
_ISSUES = "('nonhelp', 'help-degraded', 'usage-degraded', 'failed', 'container-command-missing', 'api-validation-failed', 'prepare-failed')"
_HELPFUL = "('help', 'help-degraded', 'usage-degraded')"
_SAID = r"regexp_replace(regexp_replace(coalesce(nullif(coalesce(error_text, ''), ''), nullif(coalesce(stderr, ''), ''), coalesce(stdout, '')), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"
_FACTS = rf"""
    ev AS (SELECT *, regexp_replace(regexp_replace(coalesce(command, ''), '\s+(--?help|-h|help|--?version|-v|-V)\s*$', ''), '^\s+|\s+$', '', 'g') AS base FROM {_EVENTS} WHERE pos IS NOT NULL),
    known AS (SELECT pos, {_STRIP.format("container_help_text")} <> '' OR {_STRIP.format("container_usage_text")} <> '' AS has_text FROM tool_records),
    good AS (SELECT pos, base, bool_or(status = 'help') AS clean FROM ev WHERE status IN {_HELPFUL} GROUP BY ALL),
    rec AS (SELECT pos, bool_or(status IN {_HELPFUL}) AS any_help FROM ev GROUP BY pos),
    iss AS (SELECT ev.*, {_EV_CAT} AS category, has_text OR any_help AS context FROM ev JOIN known USING (pos) JOIN rec USING (pos) LEFT JOIN good USING (pos, base)
        WHERE status IN {_ISSUES} AND NOT (good.clean IS NOT NULL AND (status NOT IN ('help-degraded', 'usage-degraded') OR good.clean))),
    sig AS (SELECT *, concat_ws('|', status, category, CASE WHEN category IN ('api_import_failure', 'runtime_dependency_missing') OR status = 'container-command-missing' THEN {_KEY.format("primary_command")} ELSE coalesce(command, '') END, {_SAID}) AS signature
        FROM iss WHERE NOT (context AND category IN ('api_import_failure', 'bad_probe_variant', 'helper_script_probe'))),
    cont AS (SELECT pos, 'container' AS kind, status, category, CASE WHEN category IN ('bad_probe_variant', 'helper_script_probe') THEN 'partial' WHEN status IN ('failed', 'container-command-missing', 'api-validation-failed', 'prepare-failed') THEN 'hard' ELSE 'partial' END AS severity, event_id AS seq
        FROM (SELECT *, row_number() OVER (PARTITION BY pos, signature ORDER BY event_id) AS k FROM sig) WHERE k = 1),
    src AS (SELECT *, {_SRC_STATUS} AS st FROM source_mappings WHERE pos IS NOT NULL),
    facts AS (SELECT * FROM cont
        UNION ALL SELECT pos, 'source', st, {_SRC_CAT}, 'partial', mapping_id FROM src WHERE NOT {_USABLE}
        UNION ALL SELECT pos, 'source', 'no_source_mapping', 'no_source_mapping', 'partial', 0 FROM tool_records r WHERE coalesce(len(requirement_packages), 0) > 0 AND NOT EXISTS (SELECT 1 FROM src WHERE src.pos = r.pos)
        UNION ALL SELECT pos, 'coverage', 'no_container_help', 'no_container_help', 'partial', 0 FROM rec JOIN known USING (pos) WHERE NOT has_text)"""
_WRAPPER = "coalesce(nullif(coalesce(wrapper_path, ''), ''), concat(coalesce(package_id, ''), ':', coalesce(tool_id, '')))"
_ROLLUP = f"""(SELECT {_WRAPPER} AS wrapper, arg_min(coalesce(package_id, ''), pos) AS package_id, arg_min(coalesce(tool_id, ''), pos) AS tool_id, list_sort(list(DISTINCT category)) AS categories,
    list_sort(list(DISTINCT status)) AS statuses, CASE WHEN bool_or(severity = 'hard') THEN 'hard' ELSE 'partial' END AS severity FROM {{0}} JOIN tool_records USING (pos) GROUP BY 1)"""


def index_packages(s, d):  # noqa: ANN001, ANN201
    return corpus.index_packages(_records(s, d))


def index_wrappers(s, d):  # noqa: ANN001, ANN201
    return corpus.index_wrappers(_records(s, d)).select("wrapper", "pos", "package_id", "suite_id")


def index_suites(s, d):  # noqa: ANN001, ANN201
    return corpus.index_suites(_records(s, d))


def best_candidates(s, d):  # noqa: ANN001, ANN201
    """The best candidate image of each record by the six-part order."""
    c = corpus.image_candidates(_records(s, d).select("pos", "requirement_packages", "requirement_versions", "container_candidate_details"))
    return relational.first_n(c, ["pos"], corpus.candidate_order()).select("pos", "image", "source", "priority")


def image_priorities(s, d):  # noqa: ANN001, ANN201
    """Of equal images of a record the highest priority is kept, the first of ties."""
    c = corpus.image_candidates(_records(s, d).select("pos", "requirement_packages", "requirement_versions", "container_candidate_details"))
    return relational.first_n(c, ["pos", "image"], [F.desc("priority"), F.asc("k")]).select("pos", "image", "source", "priority")


def image_parts(s, d):  # noqa: ANN001, ANN201
    e = table(s, d, "container_events").select("image").distinct()
    return e.select("image", keys.image_name("image").alias("name"), keys.image_version("image").alias("version"), keys.image_error("image").alias("error"))


def version_issues(s, d):  # noqa: ANN001, ANN201
    """Requirements whose version isn't in the selected image, and mappings whose version doesn't match."""
    r = _records(s, d).where(~text.blank("selected_container"))
    need = r.select("pos", keys.image_version("selected_container").alias("have"), F.explode("requirement_versions").alias("package", "version"))
    return need.where((text.stripped("version") != "") & ~F.col("have").contains(text.stripped("version"))).select("pos", "package", "version", "have")


def mapping_versions(s, d):  # noqa: ANN001, ANN201
    """How the required version of each mapping compares with the one in its URL."""
    m = _sources(s, d).withColumn("offered", F.regexp_extract(text.filled("source_url"), r"/([^/]+)\.tar\.gz$", 1))
    return relational.frequencies(m.withColumn("match", keys.version_match("required_version", "offered")), "source_channel", "match")


def nearest_versions(s, d):  # noqa: ANN001, ANN201
    """Of each required package's versions in use, the one nearest to the one that the record requires."""
    m = _sources(s, d).where(~text.blank("required_version"))
    near = versions.nearest(m, "required_package", "required_version").withColumnRenamed("nearest", "offered")
    j = m.select("mapping_id", "required_package", "required_version").join(near, ["required_package", "required_version"])
    return j.groupBy("mapping_id").agg(F.min(keys.version_rank("required_version", "offered")).alias("best")).select("mapping_id", "best.tier", "best.version")


def requirement_union(s, d):  # noqa: ANN001, ANN201
    """Of each requirement of a package's records the first version in input order, and how many there are."""
    r = _records(s, d).where(~text.blank("package_id")).select("package_id", "pos", F.explode("requirement_versions").alias("requirement", "version"))
    return r.groupBy("package_id", "requirement").agg(F.min_by("version", "pos").alias("version"), F.countDistinct("version").alias("versions"))


def datatype_sets(s, d):  # noqa: ANN001, ANN201
    """Comma-split, sorted datatypes of inputs and outputs, and their likeness."""
    r = _records(s, d).select("pos", keys.comma_set("input_datatypes").alias("i"), keys.comma_set("output_datatypes").alias("o"))
    return r.select("pos", F.array_join("i", ",").alias("inputs"), F.array_join("o", ",").alias("outputs"), numbers.jaccard("i", "o").alias("likeness"))


def datatype_report(s, d):  # noqa: ANN001, ANN201
    """Known and unknown datatypes: how often each is an input, an output, and whether it is known."""
    known = ["fasta", "fastq", "bam", "sam", "cram", "vcf", "bcf", "bed", "gff3", "gtf", "txt", "tabular", "csv", "tsv", "json", "html", "pdf", "png"]
    r = _records(s, d)
    side = lambda c, name: r.select(F.lit(name).alias("side"), F.explode(keys.comma_set(c)).alias("datatype"))
    return side("input_datatypes", "input").union(side("output_datatypes", "output")).groupBy("datatype").agg(F.count_if(F.col("side") == "input").alias("inputs"), F.count_if(F.col("side") == "output").alias("outputs"), F.col("datatype").isin(*known).alias("known"))


def fidelity(s, d):  # noqa: ANN001, ANN201
    """Each re-extracted wrapper against its first extraction: likeness of datatypes and requirements, means by suite."""
    r = _records(s, d).where(~text.blank("wrapper_path")).select("wrapper_path", "pos", "suite_id", keys.comma_set("input_datatypes").alias("i"), keys.comma_set("output_datatypes").alias("o"), keys.comma_set("requirement_packages").alias("p"))
    first = relational.first_wins(r, ["wrapper_path"], "pos").select("wrapper_path", *[F.col(c).alias(f"first_{c}") for c in ("pos", "i", "o", "p")])
    j = r.join(first, "wrapper_path").where("pos <> first_pos")
    return j.groupBy("suite_id").agg(F.count("*").alias("compared"), *[numbers.mean(numbers.jaccard(c, f"first_{c}")).alias(f"mean_{c}") for c in ("i", "o", "p")])


def resume_pending(s, d):  # noqa: ANN001, ANN201
    done = _events(s, d).where("phase = 'probe' AND status = 'help'")
    return relational.pending(_records(s, d).select("pos", "package_id"), done, "pos")


def retry_wanted(s, d):  # noqa: ANN001, ANN201
    """Records named by tool id or by path in the list of failed commands' records."""
    failed = table(s, d, "container_events").where("status = 'failed'").join(_records(s, d).select("pos", "tool_id"), "pos").select(F.col("tool_id").alias("name")).where("name IS NOT NULL AND name <> ''")
    return relational.wanted(_records(s, d).select("pos", "tool_id", "wrapper_path"), failed, "name", ["tool_id", "wrapper_path"]).select("pos")


def run_comparison(s, d):  # noqa: ANN001, ANN201
    """The first against the later half of the extraction, by wrapper path, last of each side."""
    r = _records(s, d).where(~text.blank("wrapper_path")).select("wrapper_path", "pos", "tool_id", "package_id", "primary_command")
    half = F.pmod("pos", F.lit(2))
    left, right = (relational.last_wins(r.where(half == k), ["wrapper_path"], "pos") for k in (0, 1))
    return relational.comparison_counts(relational.compared(left, right, "wrapper_path", ["tool_id", "package_id", "primary_command"]))


def package_status(s, d):  # noqa: ANN001, ANN201
    """The worst status of each package, by a ranking."""
    e = _events(s, d).join(_records(s, d).select("pos", "package_id"), "pos")
    return e.groupBy("package_id").agg(relational.worst_status("status", ["failed", "container-command-missing", "nonhelp", "help-degraded", "help"], "none").alias("worst"), F.count("*").alias("events"))


def unique_commands(s, d):  # noqa: ANN001, ANN201
    """Commands repeated in a record are numbered."""
    e = _events(s, d).where("pos IS NOT NULL AND command IS NOT NULL")
    return relational.ordinal_names(e, ["pos"], "command", "event_id").select("event_id", "unique_name")


def late_events(s, d):  # noqa: ANN001, ANN201
    """Events by phase: delivered twice, and logged more than a day after they began."""
    e = table(s, d, "container_events")
    per = e.groupBy("event_id", "phase").agg(F.count("*").alias("times"), F.min("started_at").alias("began"), F.max("logged_at").alias("logged"))
    return per.groupBy("phase").agg(F.count("*").alias("events"), F.sum(F.col("times") - 1).alias("repeats"), F.count_if(F.col("logged") > F.col("began") + F.expr("INTERVAL 1 DAY")).alias("late"))


def split_summary(s, d):  # noqa: ANN001, ANN201
    m = table(s, d, "split_members").select("pos", F.lower(text.stripped("split")).alias("split"), "source").distinct()
    return m.where("split <> ''").groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("source").alias("sources"), F.count_if(F.col("source").isNull()).alias("without_source"))


QUERIES = {
    f.__name__: f
    for f in (
        event_status_frequency, event_counters, help_coverage, record_event_flags, source_status_counts, source_category_counts, source_coverage, event_categories, failure_facts, failure_inventory,
        failure_packages, failure_samples, failure_samples_all, failure_wrappers, retry_manifest, index_packages, index_wrappers, index_suites, best_candidates, image_priorities, image_parts, version_issues,
        mapping_versions, nearest_versions, requirement_union, datatype_sets, datatype_report, fidelity, resume_pending, retry_wanted, run_comparison, package_status, unique_commands, late_events, split_summary,
    )
}

_COMMA = "list_sort(list_distinct(list_filter(list_transform(flatten(list_transform(coalesce({0}, []), lambda x: string_split(coalesce(x, ''), ','))), lambda x: lower(trim(x, ' ' || chr(9) || chr(10) || chr(13)))), lambda x: x <> '')))"
_JAC = "CASE WHEN len(list_distinct(list_concat({0}, {1}))) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) END"
_CAND = "(SELECT pos, requirement_packages AS rp, requirement_versions AS rv, unnest(container_candidate_details) AS c, generate_subscripts(container_candidate_details, 1) - 1 AS k FROM tool_records)"
_KEYS = r"list_distinct(list_transform(coalesce({0}, []), lambda p: regexp_replace(lower(coalesce(p, '')), '[^a-z0-9]+', '', 'g')))"
_IMGV = "CASE WHEN contains({0}, '@') THEN string_split({0}, '@')[-1] WHEN contains(string_split({0}, '/')[-1], ':') THEN string_split(string_split({0}, '/')[-1], ':')[-1] ELSE '' END"
_VTEXT = r"regexp_replace(regexp_replace(lower(" + _STRIP + r"), '^[<>=!~]+\s*', ''), '^v([0-9])', '\1')"
_VTOK = r"regexp_replace(array_to_string(list_transform(regexp_extract_all({0}, '(\d+|[a-z]+)'), lambda x: regexp_replace(x, '^0+(\d)', '\1')), '.'), '^0$|(\.0)+$', '')"
_OFF = r"regexp_extract(coalesce(source_url, ''), '/([^/]+)\.tar\.gz$', 1)"
_W, _O = _VTEXT.format("required_version"), _VTEXT.format(_OFF)

ORACLES = {
    "event_status_frequency": f"SELECT status, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, status)::INTEGER AS place FROM {_EVENTS} GROUP BY status",
    "event_counters": f"""SELECT (SELECT count(DISTINCT c.image) FROM {_CAND} WHERE c.image <> '' AND coalesce(c.status, 'ok') = 'ok') AS images_planned, count(DISTINCT nullif(image, '')) AS images_prepared,
        count(*) FILTER (phase IN ('probe', 'run', 'api_validation')) AS commands_executed, count(*) FILTER (status NOT IN {_HELPFUL}) AS commands_failed, count(*) FILTER (status = 'help') AS help_ok,
        count(*) FILTER (status = 'help-degraded') AS help_degraded, count(*) FILTER (status = 'usage-degraded') AS usage_degraded, count(*) FILTER (phase = 'api_validation' AND status IN {_HELPFUL}) AS api_validation_ok,
        count(*) FILTER (phase = 'api_validation' AND status NOT IN {_HELPFUL}) AS api_validation_failed, count(*) FILTER (status = 'container-command-missing') AS missing_command,
        count(*) FILTER (status = 'nonhelp') AS non_help_output, count(*) FILTER (status = 'failed') AS failed_probe, count(*) FILTER (returncode = 124) AS timed_out FROM {_EVENTS}""",
    "help_coverage": f"""WITH f AS (SELECT pos, bool_or(status = 'help') AS h, bool_or(phase = 'api_validation' AND status = 'help') AS v, bool_or(phase = 'api_validation' AND status <> 'help') AS i FROM {_EVENTS} GROUP BY pos),
        r AS (SELECT pos, {_STRIP.format("container_help_text")} <> '' AS a, {_STRIP.format("container_usage_text")} <> '' AS b, {_STRIP.format("help_text")} <> '' AS c FROM tool_records)
        SELECT count(*) AS records, count(*) FILTER (a) AS help, count(*) FILTER (b) AS usage, count(*) FILTER (c) AS documented, count(*) FILTER (h) AS event_help, count(*) FILTER (v) AS validation_ok, count(*) FILTER (i) AS validation_failed,
        count(*) FILTER (NOT a AND NOT b) AS unresolved FROM r LEFT JOIN f USING (pos)""",
    "record_event_flags": f"""SELECT pos, count(*) AS events, bool_or(status = 'help') AS helped, bool_or(status IN ('failed', 'container-command-missing')) AS failed, arg_min(status, event_id) AS first_status, arg_max(status, event_id) AS last_status
        FROM {_EVENTS} WHERE pos IS NOT NULL GROUP BY pos""",
    "source_status_counts": f"SELECT {_SRC_STATUS} AS source_status, count(*) AS n FROM source_mappings GROUP BY 1",
    "source_category_counts": f"WITH src AS (SELECT *, {_SRC_STATUS} AS st FROM source_mappings) SELECT st AS source_status, {_SRC_CAT} AS category, count(*) AS n FROM src WHERE NOT {_USABLE} GROUP BY ALL",
    "source_coverage": f"""WITH src AS (SELECT *, {_SRC_STATUS} AS st FROM source_mappings), m AS (SELECT pos, bool_or({_USABLE}) AS u, bool_or(st = 'provider_source') AS p, bool_or(st = 'source_error') AS e FROM src GROUP BY pos)
        SELECT count(*) AS records, count(*) FILTER (u IS NULL) AS unmapped, count(*) FILTER (u) AS usable, count(*) FILTER (p) AS provider, count(*) FILTER (e) AS error FROM tool_records LEFT JOIN m USING (pos)""",
    "event_categories": f"SELECT status, {_EV_CAT} AS category, count(*) AS n FROM {_EVENTS} WHERE status IN {_ISSUES} GROUP BY ALL",
    "failure_facts": f"WITH {_FACTS} SELECT pos, kind, status, category, severity, seq FROM facts",
    "failure_inventory": f"WITH {_FACTS} SELECT category, status, count(*) AS n, count(*) FILTER (severity = 'hard') AS hard FROM facts GROUP BY GROUPING SETS ((category), (status), (category, status))",
    "failure_packages": f"""WITH {_FACTS}, c AS (SELECT coalesce(package_id, '') AS package_id, count(*) AS n FROM facts JOIN tool_records USING (pos) WHERE coalesce(package_id, '') <> '' GROUP BY 1 ORDER BY n DESC, package_id LIMIT 50)
        SELECT package_id, n, row_number() OVER (ORDER BY n DESC, package_id)::INTEGER AS place FROM c""",
    "failure_samples": f"WITH {_FACTS} SELECT category, pos, seq, place FROM (SELECT category, pos, seq, row_number() OVER (PARTITION BY category ORDER BY pos, seq)::INTEGER AS place FROM facts WHERE kind = 'source') WHERE place <= 10",
    "failure_samples_all": f"WITH {_FACTS} SELECT category, pos, kind, seq, place FROM (SELECT category, pos, kind, seq, row_number() OVER (PARTITION BY category ORDER BY pos, kind, seq)::INTEGER AS place FROM facts) WHERE place <= 10",
    "failure_wrappers": f"WITH {_FACTS} SELECT wrapper, package_id, tool_id, array_to_string(categories, ',') AS categories, array_to_string(statuses, ',') AS statuses, severity FROM {_ROLLUP.format('facts')}",
    "retry_manifest": f"""WITH {_FACTS}, again AS (SELECT * FROM facts WHERE category IN ({', '.join(repr(c) for c in corpus.RETRY_CATEGORIES)}) OR (severity = 'hard' AND category NOT IN ({', '.join(repr(c) for c in corpus.HARD_BUT_FINAL_CATEGORIES)})))
        SELECT severity, count(*) AS wrappers, sum(len(categories))::BIGINT AS categories FROM {_ROLLUP.format('again')} GROUP BY severity""",
    "index_packages": f"SELECT package_id, count(*) AS wrappers, arg_min_null(wrapper_path, pos) AS first_wrapper, arg_max_null(wrapper_path, pos) AS last_wrapper, count(DISTINCT {_WRAPPER}) AS distinct_wrappers FROM tool_records WHERE {_STRIP.format('package_id')} <> '' GROUP BY package_id",
    "index_wrappers": """WITH w AS (SELECT coalesce(nullif(coalesce(tool_id, ''), ''), coalesce(wrapper_path, '')) AS wrapper, pos, package_id, suite_id FROM tool_records)
        SELECT wrapper, pos, package_id, suite_id FROM w WHERE wrapper <> '' QUALIFY row_number() OVER (PARTITION BY wrapper ORDER BY pos DESC) = 1""",
    "index_suites": f"""SELECT suite_id, count(DISTINCT nullif(coalesce(package_id, ''), '')) AS packages, arg_min(suite_name, pos) FILTER ({_STRIP.format("suite_name")} <> '') AS suite_name FROM tool_records WHERE {_STRIP.format("suite_id")} <> '' GROUP BY suite_id""",
    "best_candidates": f"""WITH c AS (SELECT pos, k, c.image AS image, c.source AS source, c.priority AS priority, {_KEYS.format("rp")} AS need, {_KEYS.format("c.packages")} AS have, list_filter(map_values(rv), lambda v: trim(coalesce(v, '')) <> '') AS vs FROM {_CAND}),
        r AS (SELECT *, len(list_intersect(need, have)) AS cov, {_IMGV.format("image")} AS iv FROM c)
        SELECT pos, image, source, priority FROM r QUALIFY row_number() OVER (PARTITION BY pos ORDER BY (len(need) > 0 AND cov = len(need)) DESC, cov DESC, CASE source WHEN 'xml' THEN 3 WHEN 'mulled' THEN 2 WHEN 'lookup' THEN 1 ELSE 0 END DESC,
            coalesce(len(list_filter(vs, lambda v: contains(iv, trim(v)))) > 0, false) DESC, coalesce(priority, 0) DESC, image, k) = 1""",
    "image_priorities": f"SELECT pos, c.image AS image, c.source AS source, c.priority AS priority FROM {_CAND} QUALIFY row_number() OVER (PARTITION BY pos, c.image ORDER BY c.priority DESC, k) = 1",
    "image_parts": rf"""SELECT DISTINCT image, split_part(split_part(string_split(coalesce(image, ''), '/')[-1], '@', 1), ':', 1) AS name, {_IMGV.format("coalesce(image, '')")} AS version, CASE WHEN trim(coalesce(image, '')) = '' THEN 'empty'
        WHEN regexp_matches(image, '[{{}}$]|<[^>]*>') THEN 'placeholder' WHEN regexp_matches(trim(image), '\s') THEN 'white space' WHEN contains(image, '==') THEN 'double equals sign' ELSE '' END AS error FROM container_events""",
    "version_issues": f"""WITH r AS (SELECT pos, {_IMGV.format("coalesce(selected_container, '')")} AS have, unnest(map_entries(requirement_versions)) AS e FROM tool_records WHERE {_STRIP.format("selected_container")} <> '')
        SELECT pos, e.key AS package, e.value AS version, have FROM r WHERE trim(coalesce(e.value, '')) <> '' AND NOT contains(have, trim(e.value))""",
    "mapping_versions": f"""SELECT source_channel, CASE WHEN {_W} = '' THEN 'not_required' WHEN {_O} = '' THEN 'unknown' WHEN {_W} = {_O} THEN 'exact' WHEN {_VTOK.format(_W)} = {_VTOK.format(_O)} THEN 'numeric_equivalent' ELSE 'mismatch' END AS match, count(*) AS n
        FROM source_mappings GROUP BY ALL""",
    "requirement_union": f"""WITH r AS (SELECT package_id, pos, unnest(map_entries(requirement_versions)) AS e FROM tool_records WHERE {_STRIP.format("package_id")} <> '')
        SELECT package_id, e.key AS requirement, arg_min_null(e.value, pos) AS version, count(DISTINCT e.value) AS versions FROM r GROUP BY 1, 2""",
    "datatype_sets": f"WITH r AS (SELECT pos, {_COMMA.format('input_datatypes')} AS i, {_COMMA.format('output_datatypes')} AS o FROM tool_records) SELECT pos, array_to_string(i, ',') AS inputs, array_to_string(o, ',') AS outputs, {_JAC.format('i', 'o')} AS likeness FROM r",
    "datatype_report": f"""WITH u AS (SELECT 'input' AS side, unnest({_COMMA.format("input_datatypes")}) AS datatype FROM tool_records UNION ALL SELECT 'output', unnest({_COMMA.format("output_datatypes")}) FROM tool_records)
        SELECT datatype, count(*) FILTER (side = 'input') AS inputs, count(*) FILTER (side = 'output') AS outputs, datatype IN ('fasta', 'fastq', 'bam', 'sam', 'cram', 'vcf', 'bcf', 'bed', 'gff3', 'gtf', 'txt', 'tabular', 'csv', 'tsv', 'json', 'html', 'pdf', 'png') AS known FROM u GROUP BY datatype""",
    "fidelity": f"""WITH r AS (SELECT wrapper_path, pos, suite_id, {_COMMA.format("input_datatypes")} AS i, {_COMMA.format("output_datatypes")} AS o, {_COMMA.format("requirement_packages")} AS p FROM tool_records WHERE {_STRIP.format("wrapper_path")} <> ''),
        f AS (SELECT wrapper_path, pos AS fp, i AS fi, o AS fo, p AS fpk FROM r QUALIFY row_number() OVER (PARTITION BY wrapper_path ORDER BY pos) = 1)
        SELECT suite_id, count(*) AS compared, avg({_JAC.format("i", "fi")}) AS mean_i, avg({_JAC.format("o", "fo")}) AS mean_o, avg({_JAC.format("p", "fpk")}) AS mean_p FROM r JOIN f USING (wrapper_path) WHERE pos <> fp GROUP BY suite_id""",
    "resume_pending": "SELECT pos, package_id FROM tool_records WHERE pos NOT IN (SELECT pos FROM container_events WHERE phase = 'probe' AND status = 'help' AND pos IS NOT NULL)",
    "retry_wanted": """WITH f AS (SELECT DISTINCT tool_id AS name FROM container_events e JOIN tool_records USING (pos) WHERE e.status = 'failed' AND tool_id <> '')
        SELECT pos FROM tool_records WHERE tool_id IN (SELECT name FROM f) OR wrapper_path IN (SELECT name FROM f)""",
    "run_comparison": f"""WITH r AS (SELECT wrapper_path, pos, tool_id, package_id, primary_command FROM tool_records WHERE {_STRIP.format("wrapper_path")} <> ''),
        l AS (SELECT *, true AS il FROM r WHERE pos % 2 = 0 QUALIFY row_number() OVER (PARTITION BY wrapper_path ORDER BY pos DESC) = 1), g AS (SELECT *, true AS ir FROM r WHERE pos % 2 = 1 QUALIFY row_number() OVER (PARTITION BY wrapper_path ORDER BY pos DESC) = 1)
        SELECT count(*) AS keys, count(il) AS left_rows, count(ir) AS right_rows, count(*) FILTER (il AND ir) AS in_both, count(*) FILTER (il AND ir IS NULL) AS only_left, count(*) FILTER (il IS NULL AND ir) AS only_right,
        count(*) FILTER (il AND ir AND (l.tool_id IS DISTINCT FROM g.tool_id OR l.package_id IS DISTINCT FROM g.package_id OR l.primary_command IS DISTINCT FROM g.primary_command)) AS changed_rows FROM l FULL JOIN g USING (wrapper_path)""",
    "package_status": f"""SELECT package_id, coalesce(list_extract(['failed', 'container-command-missing', 'nonhelp', 'help-degraded', 'help'], min(CASE status WHEN 'failed' THEN 1 WHEN 'container-command-missing' THEN 2 WHEN 'nonhelp' THEN 3 WHEN 'help-degraded' THEN 4 WHEN 'help' THEN 5 END)), 'none') AS worst,
        count(*) AS events FROM {_EVENTS} e JOIN tool_records USING (pos) GROUP BY package_id""",
    "unique_commands": f"""SELECT event_id, CASE WHEN k = 1 THEN command ELSE command || '_' || k END AS unique_name FROM (SELECT event_id, command, row_number() OVER (PARTITION BY pos, command ORDER BY event_id) AS k FROM {_EVENTS} WHERE pos IS NOT NULL AND command IS NOT NULL)""",
    "late_events": """WITH p AS (SELECT event_id, phase, count(*) AS t, min(started_at) AS b, max(logged_at) AS l FROM container_events GROUP BY ALL)
        SELECT phase, count(*) AS events, sum(t - 1)::BIGINT AS repeats, count(*) FILTER (l > b + INTERVAL 1 DAY) AS late FROM p GROUP BY phase""",
    "split_summary": f"""WITH m AS (SELECT DISTINCT pos, lower({_STRIP.format("split")}) AS split, source FROM split_members)
        SELECT split, count(*) AS records, count(DISTINCT source) AS sources, count(*) FILTER (source IS NULL) AS without_source FROM m WHERE split <> '' GROUP BY split""",
}
