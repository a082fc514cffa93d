"""Queries over markup, paths, commands, stores and registries, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import commands, keys, markup, paths, recipes, text
from ..operators import registry, relational
from ..session import shared_dir
from ..sources import jsonl
from .tables import table


def _wrappers(s, d):  # noqa: ANN001, ANN202
    return table(s, d, "documents").where("doc_kind = 'wrapper_xml'")


def markup_diagnostics(s, d):  # noqa: ANN001, ANN201
    """Counters and problems of each wrapper."""
    f = _wrappers(s, d).select("doc_id", markup.diagnostics("text").alias("f"))
    return f.select("doc_id", "f.options", "f.tests", "f.fragments", F.array_join("f.problems", ",").alias("problems"))


def structural_reports(s, d):  # noqa: ANN001, ANN201
    return _wrappers(s, d).select("doc_id", markup.structural_report("text").alias("r")).select("doc_id", "r.*")


def best_wrappers(s, d):  # noqa: ANN001, ANN201
    """Of each package the wrapper with the best score, the first of ties."""
    known = ["bam", "bed", "fasta", "fastq", "vcf", "txt", "tabular", "csv"]
    w = _wrappers(s, d).where("package_id IS NOT NULL").withColumns({"f": markup.xml_features("text"), "g": markup.diagnostics("text")})
    unknown = F.size(F.array_except(F.coalesce("f.datatypes", F.array().cast("array<string>")), F.array(*[F.lit(k) for k in known])))
    scored = w.withColumn("score", markup.candidate_score(F.col("f.well_formed"), F.col("f.root") == "tool", F.col("g"), "text", unknown))
    return relational.first_n(scored, ["package_id"], [F.desc("score"), F.asc("doc_id")]).select("package_id", "doc_id", "score")


def path_scores(s, d):  # noqa: ANN001, ANN201
    r = table(s, d, "tool_records").where("wrapper_path IS NOT NULL")
    return r.select("pos", paths.score("wrapper_path", F.array("package_id")).alias("score"), paths.test_score("wrapper_path", False).alias("test_score"), paths.excluded("wrapper_path").alias("excluded"), paths.ending("wrapper_path").alias("ending"))


def sidecar_files(s, d):  # noqa: ANN001, ANN201
    """Other XML files of each record by role and reason to skip them."""
    r = table(s, d, "tool_records").select("pos", "tool_dir", F.explode("xml_files").alias("file"))
    return r.select("pos", "file", paths.sidecar_role("file", F.lit("")).alias("role"), paths.skip_reason(F.concat_ws("/", "tool_dir", "file"), "tool_dir", F.lit(100), 1000).alias("skip"))


def command_signatures(s, d):  # noqa: ANN001, ANN201
    """Programs and sub-commands that the events' commands call."""
    c = table(s, d, "container_events").where("command IS NOT NULL").select("command").distinct()
    return c.select("command", F.explode(commands.called("command")).alias("c")).select("command", "c.program", "c.subcommand")


def probe_plans(s, d):  # noqa: ANN001, ANN201
    """The help commands that each record's program and sub-commands need."""
    subs = F.split(F.regexp_extract(text.filled("container_usage_text"), r"(?i)usage:\s*\S+\s*\{([^}]*)\}", 1), ",")
    r = table(s, d, "tool_records").where(~text.blank("primary_command"))
    return r.select("pos", F.explode(commands.probes(text.stripped("primary_command"), keys.distinct_strings(subs))).alias("command"))


def hint_matches(s, d):  # noqa: ANN001, ANN201
    """Records of which a required package is named like the record's own package, by command keys."""
    r = table(s, d, "tool_records").select("pos", "package_id", F.explode("requirement_packages").alias("package"))
    return r.where(keys.matching_keys("package_id", "package")).select("pos", "package")


def requirement_names(s, d):  # noqa: ANN001, ANN201
    m = table(s, d, "source_mappings").withColumn("spec", F.concat_ws(" >=", "required_package", F.nullif(text.filled("required_version"), F.lit(""))))
    return m.select("mapping_id", recipes.requirement_name("spec").alias("name"), recipes.spec_version("spec").alias("version"), recipes.repository("source_url").alias("repository"))


def jsonl_policies(s, d):  # noqa: ANN001, ANN201
    """Records written as JSON lines with every tenth one broken, read again by two policies."""
    r = table(s, d, "tool_records").select("pos", "package_id", "tool_id", "help_text", "requirement_packages")
    line = F.to_json(F.struct(F.col("pos").alias("id"), "package_id", "tool_id", "help_text", "requirement_packages"))
    path = f"{shared_dir(s).rstrip('/')}/lines-{uuid.uuid4().hex}"
    r.select(F.when(F.pmod("pos", F.lit(10)) == 0, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(path)
    schema = "id long, package_id string, tool_id string, help_text string, requirement_packages array<string>"
    counted, dropped = (jsonl.read(s, path, schema, p) for p in ("count", "drop"))
    a = counted.agg(F.count("*").alias("lines"), F.count(jsonl.CORRUPT).alias("corrupt"))
    b = jsonl.with_defaults(dropped).agg(F.count("*").alias("kept"), F.count_if(F.col("tool_id") == "").alias("without_tool"))
    return a.crossJoin(b).crossJoin(jsonl.integrity(s, path).select("invalid"))  # one row each


def run_listing(s, d):  # noqa: ANN001, ANN201
    """Extraction runs, newest first, with their records."""
    r = table(s, d, "tool_records").groupBy("run_id").agg(F.count("*").alias("records"), F.max("extracted_at").alias("ended"), F.countDistinct("package_id").alias("packages"))
    return registry.newest(r.withColumn("kind", F.lit("extract")), "ended", "run_id", "extract", 20).select("run_id", "records", "ended", "packages")


def merged_requirements(s, d):  # noqa: ANN001, ANN201
    """The newest record of each tool, its requirement versions merged over those of its first record."""
    r = table(s, d, "tool_records").where("tool_id IS NOT NULL AND tool_id <> ''").select("tool_id", "pos", "requirement_versions", "package_id")
    first, last = relational.first_wins(r, ["tool_id"], "pos"), relational.last_wins(r, ["tool_id"], "pos")
    up = registry.upserted(first, last, "tool_id", ["package_id"], ["requirement_versions"], "pos")
    return up.select("tool_id", "pos", F.size("requirement_versions").alias("requirements"), F.array_join(F.array_sort(F.map_keys("requirement_versions")), ",").alias("names"))


def record_jobs(s, d):  # noqa: ANN001, ANN201
    """Packages as jobs whose tasks are their records."""
    r = table(s, d, "tool_records")
    e = table(s, d, "container_events").groupBy("pos").agg(F.bool_or(F.col("status") == "help").alias("ok"), F.bool_or(F.col("status") == "failed").alias("bad"))
    tasks = r.select("pos").join(e, "pos", "left").select(F.col("pos").alias("task_id"), F.when(F.col("bad"), "failed").when(F.col("ok"), "completed").otherwise("pending").alias("status"))
    return tasks.join(r.select(F.col("pos").alias("task_id"), F.col("package_id").alias("job_id")), "task_id").groupBy("job_id").agg(relational.job_state("status").alias("state"), F.count_if(F.col("status") == "completed").alias("done"), F.count("*").alias("total"))


def packed_documents(s, d):  # noqa: ANN001, ANN201
    """Each package's best five documents within 3,000 characters."""
    f = table(s, d, "documents").where("package_id IS NOT NULL AND n_chars IS NOT NULL").select("package_id", "doc_id", "n_chars", (F.when(F.col("doc_kind") == "readme", 55).otherwise(0) + F.when(F.col("doc_kind") == "tool_help", 80).otherwise(0)).alias("score"))
    return registry.packed_context(f, ["package_id"], "score", "doc_id", "n_chars", 5, 3000).select("package_id", "doc_id", "place", "kept")


QUERIES = {
    f.__name__: f
    for f in (markup_diagnostics, structural_reports, best_wrappers, path_scores, sidecar_files, command_signatures, probe_plans, hint_matches, requirement_names, jsonl_policies, run_listing, merged_requirements, record_jobs, packed_documents)
}

_S = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
_T = _S.format("text")
_P = r"regexp_replace(wrapper_path, '[\\/]+', '/', 'g')"
_B = f"lower(string_split({_P}, '/')[-1])"
_SCORE = f"""(CASE WHEN contains('/' || lower({_P}), '/.github/workflows/') THEN -120 ELSE 0 END + CASE WHEN regexp_matches('/' || lower({_P}), '/(bin|scripts?)/') THEN 80 ELSE 0 END + CASE WHEN {_B} LIKE 'readme%' THEN 55 ELSE 0 END
    + CASE WHEN {_B} IN ('setup.py', 'setup.cfg', 'pyproject.toml') THEN 70 ELSE 0 END)"""
_K = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '', 'g')"
_END = rf"regexp_extract({_B}, '[^.]\.([a-z0-9_]+)$', 1)"

ORACLES = {
    "markup_diagnostics": rf"""WITH w AS (SELECT doc_id, {_T} AS t FROM documents WHERE doc_kind = 'wrapper_xml'),
        f AS (SELECT doc_id, regexp_replace(unnest(regexp_extract_all(t, '(?:#set\s+)?\$?(out_[A-Za-z0-9_]+)', 1)), '_\d+$', '') AS v FROM w), g AS (SELECT doc_id, sum(n) AS n FROM (SELECT doc_id, v, count(*) AS n FROM f GROUP BY ALL HAVING count(*) >= 8) GROUP BY doc_id),
        l AS (SELECT doc_id, regexp_replace(unnest(string_split(regexp_replace(t, '\r\n?', chr(10), 'g'), chr(10))), '^\s+|\s+$', '', 'g') AS line FROM w), m AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, line FROM l WHERE line LIKE '<%' AND length(line) >= 12 GROUP BY ALL HAVING count(*) >= 12)),
        c AS (SELECT w.doc_id, t, len(regexp_extract_all(t, '(?i)<option\b'))::INTEGER AS options, len(regexp_extract_all(t, '(?i)<test\b'))::INTEGER AS tests, coalesce(g.n, 0)::INTEGER AS fragments, m.doc_id IS NOT NULL AS rep,
            list_transform(regexp_extract_all(t, '(?is)<option\b[^>]*\bvalue=("[^"]*"|''[^'']*'')', 1), lambda v: trim(v[2:-2])) AS vals, list_transform(regexp_extract_all(t, '(?is)<option\b[^>]*>(.*?)</option>', 1), lambda v: trim(regexp_replace(v, '<[^>]+>', '', 'g'))) AS labs
            FROM w LEFT JOIN g USING (doc_id) LEFT JOIN m USING (doc_id))
        SELECT doc_id, options, tests, fragments, array_to_string(list_filter([CASE WHEN NOT contains(t, '</tool>') THEN 'no_end_tag' END, CASE WHEN regexp_matches(t, '<[^>]*\z') AND NOT t LIKE '%>' THEN 'cut_in_tag' END,
            CASE WHEN len(string_split(t, '<![CDATA[')) > len(string_split(t, ']]>')) THEN 'open_cdata' END, CASE WHEN options > 60 THEN 'many_options' END, CASE WHEN len(list_filter(vals, lambda v: length(v) > 96)) > 0 THEN 'long_values' END,
            CASE WHEN len(list_filter(labs, lambda v: length(v) > 140)) > 0 THEN 'long_labels' END, CASE WHEN rep THEN 'repeated_lines' END, CASE WHEN fragments >= 8 THEN 'repeated_fragments' END, CASE WHEN tests > 1 THEN 'many_tests' END], lambda x: x IS NOT NULL), ',') AS problems FROM c""",
    "path_scores": rf"""SELECT pos, {_SCORE} + CASE WHEN {_K.format("package_id")} <> '' AND contains({_K.format("wrapper_path")}, {_K.format("package_id")}) THEN 50 ELSE 0 END AS score,
        {_SCORE} + CASE WHEN regexp_matches('/' || lower({_P}), '/(test|example|demo)') THEN 45 ELSE 0 END + CASE WHEN regexp_matches({_B}, '^(test[_-]|example|expected)') THEN 35 ELSE 0 END
        + CASE WHEN {_END} IN ('fasta', 'fa', 'fastq', 'fq', 'sam', 'vcf', 'bed', 'gff', 'gff3', 'gtf', 'tsv', 'csv', 'tabular') THEN -25 ELSE 0 END AS test_score,
        len(list_intersect(string_split({_P}, '/'), ['.git', '.hg', '__pycache__', '.eggs', '.mypy_cache', '.nox', '.pytest_cache', '.tox', '.venv', 'build', 'dist', 'node_modules', 'site-packages', 'target', 'test', 'test-data', 'test_data', 'tests'])) > 0 OR {_P} LIKE 'docs/\_build/%' ESCAPE '\' AS excluded,
        {_END} AS ending FROM tool_records WHERE wrapper_path IS NOT NULL""",
    "command_signatures": r"""SELECT DISTINCT command, string_split(command, ' ')[1] AS program, CASE WHEN regexp_full_match(coalesce(string_split(command, ' ')[2], ''), '[a-z][a-z0-9_-]{1,30}') THEN string_split(command, ' ')[2] ELSE '' END AS subcommand FROM container_events WHERE command IS NOT NULL AND trim(command) <> ''""",
    "hint_matches": f"""WITH r AS (SELECT pos, {_K.format("package_id")} AS a, unnest(requirement_packages) AS package FROM tool_records), k AS (SELECT *, {_K.format("package")} AS b FROM r)
        SELECT pos, package FROM k WHERE a <> '' AND (a = b OR (length(a) >= 4 AND length(b) >= 4 AND (contains(a, b) OR contains(b, a))))""",
    "requirement_names": r"""SELECT mapping_id, lower(regexp_extract(coalesce(required_package, ''), '^([A-Za-z0-9][A-Za-z0-9._-]*)', 1)) AS name, regexp_extract(CASE WHEN coalesce(required_version, '') <> '' THEN required_package || ' >=' || required_version ELSE coalesce(required_package, '') END, '(?:[=<>!~]+|\s)\s*v?(\d[\w.]*)', 1) AS version,
        regexp_extract(coalesce(source_url, ''), '^(?:https?|git|ssh)://(?:[^@/]*@)?(?:www\.)?git(?:hub|lab)\.com/([\w.-]+/[\w.-]+)', 1) AS repository FROM source_mappings""",
    "jsonl_policies": "SELECT count(*) AS lines, count(*) FILTER (pos % 10 = 0) AS corrupt, count(*) FILTER (pos % 10 <> 0) AS kept, count(*) FILTER (pos % 10 <> 0 AND coalesce(tool_id, '') = '') AS without_tool, count(*) FILTER (pos % 10 = 0) AS invalid FROM tool_records",
    "run_listing": "SELECT run_id, count(*) AS records, max(extracted_at) AS ended, count(DISTINCT package_id) AS packages FROM tool_records GROUP BY run_id ORDER BY ended DESC, run_id DESC LIMIT 20",
    "merged_requirements": """WITH t AS (SELECT tool_id, arg_min(pos, pos) AS a, max(pos) AS b FROM tool_records WHERE tool_id <> '' GROUP BY tool_id), k AS (SELECT t.tool_id AS tool_id, b, list_sort(list_distinct(list_concat(coalesce(map_keys(x.requirement_versions), []), coalesce(map_keys(y.requirement_versions), [])))) AS ks
        FROM t JOIN tool_records x ON x.pos = a JOIN tool_records y ON y.pos = b WHERE true) SELECT k.tool_id AS tool_id, b AS pos, len(ks)::INTEGER AS requirements, array_to_string(ks, ',') AS names FROM k""",
    "record_jobs": """WITH e AS (SELECT pos, bool_or(status = 'help') AS ok, bool_or(status = 'failed') AS bad FROM container_events GROUP BY pos), t AS (SELECT r.package_id AS job_id, CASE WHEN bad THEN 'failed' WHEN ok THEN 'completed' ELSE 'pending' END AS status FROM tool_records r LEFT JOIN e USING (pos))
        SELECT job_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'completed') THEN 'completed' ELSE 'running' END AS state, count(*) FILTER (status = 'completed') AS done, count(*) AS total FROM t GROUP BY job_id""",
    "packed_documents": """WITH r AS (SELECT package_id, doc_id, n_chars, row_number() OVER (PARTITION BY package_id ORDER BY CASE doc_kind WHEN 'tool_help' THEN 80 WHEN 'readme' THEN 55 ELSE 0 END DESC, doc_id) AS place FROM documents WHERE package_id IS NOT NULL AND n_chars IS NOT NULL),
        u AS (SELECT *, 3000 - sum(n_chars) OVER (PARTITION BY package_id ORDER BY place) + n_chars AS room FROM r WHERE place <= 5) SELECT package_id, doc_id, place::INTEGER AS place, least(n_chars, room)::BIGINT AS kept FROM u WHERE room > 0""",
}
