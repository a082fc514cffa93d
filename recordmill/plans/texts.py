"""Queries over texts, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, markup, text
from ..operators import relational, texts
from .tables import table


def probe_outcomes(s, d):  # noqa: ANN001, ANN201
    """What the container help texts amount to, as if they were probe output."""
    r = table(s, d, "tool_records").where(~text.blank("container_help_text"))
    return relational.frequencies(r.withColumn("outcome", text.probe_outcome("container_help_text", F.lit(0))), "outcome")


def option_line_counts(s, d):  # noqa: ANN001, ANN201
    return table(s, d, "tool_records").select("pos", text.option_lines("container_help_text").alias("option_lines"), text.looks_like_help("container_help_text").alias("is_help"))


def collapsed_lines(s, d):  # noqa: ANN001, ANN201
    """Lines kept and left out of each document if a line may occur twice."""
    return texts.collapsed(table(s, d, "documents"), "doc_id", "text")


def repeated_lines(s, d):  # noqa: ANN001, ANN201
    """Lines of three characters or more that a document has twice or more."""
    return texts.repeated_lines(table(s, d, "documents"), "doc_id", "text", 3, 2)


def interface_lines(s, d):  # noqa: ANN001, ANN201
    """Lines of help by what they tell of: usage, options, inputs, outputs."""
    return texts.interface_lines(table(s, d, "tool_records"), "pos", "help_text").groupBy("pos").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("usage", "option", "input", "output")])


def datatype_terms(s, d):  # noqa: ANN001, ANN201
    """Known datatypes that a document names, in the order of the list."""
    return texts.terms(table(s, d, "documents").select("doc_id", "text"), "doc_id", "text", ["fasta", "fastq", "bam", "sam", "vcf", "bed", "gtf", "gff3", "csv", "tsv", "json", "html", "png"])


def markup_spans(s, d):  # noqa: ANN001, ANN201
    """Complete tool spans of each document and their length."""
    n = text.spans("text", "tool")
    return table(s, d, "documents").where("doc_kind = 'wrapper_xml'").select("doc_id", F.size(n).alias("spans"), F.coalesce(F.length(F.try_element_at(n, F.lit(1))), F.lit(0)).alias("chars"), text.open_fence("text").alias("open_fence"))


def structure_score(s, d):  # noqa: ANN001, ANN201
    """Weighted presence of the parts that a wrapper has, by tags."""
    return table(s, d, "documents").where("doc_kind = 'wrapper_xml'").select("doc_id", markup.structure_score("text").alias("score"))


def markup_features(s, d):  # noqa: ANN001, ANN201
    """What a parser finds in each wrapper; null where it is malformed."""
    f = markup.xml_features(F.col("text"))
    return table(s, d, "documents").where("doc_kind = 'wrapper_xml'").select("doc_id", f.alias("f")).select("doc_id", "f.well_formed", "f.inputs", "f.outputs", "f.tests", F.array_join("f.datatypes", ",").alias("datatypes"))


def yaml_features(s, d):  # noqa: ANN001, ANN201
    f = markup.yaml_features(F.col("text"))
    return table(s, d, "documents").where("doc_kind = 'config'").select("doc_id", f.alias("f")).select("doc_id", "f.well_formed", "f.kind", "f.keys")


def file_names(s, d):  # noqa: ANN001, ANN201
    r = table(s, d, "tool_records").where("tool_id IS NOT NULL")
    return r.select("pos", text.file_slug("tool_id").alias("file"), text.slug("tool_id").alias("slug"), text.command_key("tool_id").alias("key"))


def natural_order(s, d):  # noqa: ANN001, ANN201
    """Customers' segments by name with numbers by value, and the first and last name of each."""
    c = table(s, d, "customer").withColumn("k", keys.natural_key(F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string"))))
    return c.groupBy("c_mktsegment").agg(F.min_by("c_custkey", "k").alias("first"), F.max_by("c_custkey", "k").alias("last"))


def command_parts(s, d):  # noqa: ANN001, ANN201
    """First command and sub-commands of each record's usage text."""
    u = text.filled("container_usage_text")
    inside = F.regexp_extract(u, r"(?i)usage:\s*\S+\s*\{([^}]*)\}", 1)
    subs = keys.distinct_strings(F.split(inside, ","))
    return table(s, d, "tool_records").where(~text.blank("container_usage_text")).select("pos", F.regexp_extract(u, r"(?i)usage:\s*([\w.-]+)", 1).alias("program"), F.array_join(subs, ",").alias("subcommands"))


def truncated_bytes(s, d):  # noqa: ANN001, ANN201
    """Help texts cut to 500 bytes without cutting a character."""
    return table(s, d, "tool_records").where("help_text IS NOT NULL").select("pos", F.octet_length(texts.truncate_bytes(F.col("help_text"), 500)).alias("bytes"), (F.octet_length("help_text") > 500).alias("cut"))


def shaped_help(s, d):  # noqa: ANN001, ANN201
    """Help within a budget of 700 characters: beginning, then key lines, then the rest."""
    return texts.shaped(table(s, d, "tool_records").select("pos", "help_text"), "pos", "help_text", 700)


def json_fields(s, d):  # noqa: ANN001, ANN201
    """The number in the events' JSON by type."""
    e = table(s, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return e.groupBy("event_type").agg(F.count("k").alias("with_k"), F.sum("k").alias("total"), F.min("k").alias("least"), F.max("k").alias("most"))


def combined_help(s, d):  # noqa: ANN001, ANN201
    """Length and hash of each record's joined help sections."""
    c = text.combined_help("help_text", "container_help_text", "container_usage_text")
    return table(s, d, "tool_records").select("pos", F.length(c).alias("chars"), F.sha2(c, 256).alias("hash"))


def option_prefixes(s, d):  # noqa: ANN001, ANN201
    """Options whose first letters occur five times or more in one container help text."""
    o = F.explode(F.regexp_extract_all(text.filled("container_help_text"), F.lit(r"--([a-z]+)-"), F.lit(1))).alias("prefix")
    return table(s, d, "tool_records").select("pos", o).groupBy("pos", "prefix").agg(F.count("*").alias("n")).where("n >= 5")


QUERIES = {
    f.__name__: f
    for f in (probe_outcomes, option_line_counts, collapsed_lines, repeated_lines, interface_lines, datatype_terms, markup_spans, structure_score, markup_features, yaml_features, file_names, natural_order, command_parts, truncated_bytes, shaped_help, json_fields, combined_help, option_prefixes)
}

_S = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
_LINES = r"unnest(string_split(regexp_replace(coalesce({0}, ''), '\r\n?', chr(10), 'g'), chr(10)))"
_OPT = r"(?m)^\s*((#|//|\*)+\s*)?\s*(\[?\(?-{1,2}[A-Za-z0-9][A-Za-z0-9_-]*|\[?\(?-[A-Za-z](,|\)|\||\s))"
_C = "coalesce(container_help_text, '')"
_HELP = rf"""(regexp_matches(lower({_C}), 'usage:|options:|optional arguments|--help|commands:|available analysis command line options|available command line options|for more information about a specific command|commandname\(help\)')
    OR regexp_matches({_C}, '(?im)^\s*(usage|options?|commands?)\s*:') OR (regexp_matches({_C}, '(?im)^\s*synopsis\s*$') AND regexp_matches({_C}, '(?im)^\s*(options?|arguments?|parameters?)\s*$'))
    OR (contains(lower({_C}), 'help follows') AND regexp_matches({_C}, '(?im)^\s*command\s+description\b')) OR (contains(lower({_C}), 'tool:') AND contains(lower({_C}), 'summary:')) OR len(regexp_extract_all({_C}, '{_OPT}')) >= 3)"""
_FATAL = "can''t open file|cannot open file|command not found|could not find or load main class|invalid choice|no such file or directory|not found|syntax error|you ran:"
_STRONG = "can''t open file|cannot open file|command not found|could not find or load main class|invalid choice|syntax error|you ran:"
_DEGR = "command not recognized|illegal option|need -g|unrecognized parameter|unrecognized option|unknown option"
_L = f"lower({_C})"
_EXC = f"(regexp_matches({_L}, 'cannot change locale|warning:') AND NOT regexp_matches({_L}, 'command not found|could not find or load main class|you ran:'))"
_FAILED = f"(NOT (h AND (NOT regexp_matches({_L}, '{_STRONG}') OR {_EXC})) AND regexp_matches({_L}, '{_FATAL}|{_DEGR}'))"

ORACLES = {
    "probe_outcomes": rf"""WITH b AS (SELECT *, {_HELP} AS h FROM tool_records WHERE {_S.format("container_help_text")} <> ''),
        c AS (SELECT CASE WHEN h AND regexp_matches({_L}, '{_DEGR}') AND (NOT regexp_matches({_L}, '{_STRONG}') OR {_EXC}) THEN 'help-degraded' WHEN h AND NOT {_FAILED} THEN 'help'
            WHEN NOT h AND (contains({_L}, 'type ''help'' or ''?'' for help') OR (contains({_L}, 'please provide') AND regexp_matches({_L}, 'no further parameters|parameters are necessary')) OR regexp_matches({_L}, '\b(expected|requires?)\s+\d+\s+(arguments?|parameters?)\b')) THEN 'usage-degraded'
            WHEN {_FAILED} OR (NOT h AND contains({_L}, 'traceback') AND (regexp_matches({_L}, 'attributeerror:|importerror:|modulenotfounderror:|nameerror:|cannot open shared object file|global name ''exc''|pkg_resources') OR (contains({_L}, 'indexerror: list index out of range') AND contains({_L}, 'sys.argv[')))) THEN 'failed' ELSE 'nonhelp' END AS outcome FROM b)
        SELECT outcome, count(*) AS n FROM c GROUP BY outcome""",
    "option_line_counts": f"SELECT pos, len(regexp_extract_all({_C}, '{_OPT}'))::INTEGER AS option_lines, {_HELP} AS is_help FROM tool_records",
    "collapsed_lines": rf"""WITH l AS (SELECT doc_id, {_LINES.format("text")} AS line, generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)), 1) AS k FROM documents),
        t AS (SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t, k FROM l), n AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id, t ORDER BY k) AS r FROM t)
        SELECT doc_id, count(*) FILTER (t = '' OR r <= 2) AS kept, count(*) FILTER (t <> '' AND r > 2) AS omitted FROM n GROUP BY doc_id""",
    "repeated_lines": rf"""WITH l AS (SELECT doc_id, regexp_replace({_LINES.format("text")}, '^\s+|\s+$', '', 'g') AS line FROM documents) SELECT doc_id, line, count(*) AS times FROM l WHERE length(line) >= 3 GROUP BY ALL HAVING count(*) >= 2""",
    "interface_lines": rf"""WITH l AS (SELECT pos, regexp_replace({_LINES.format("help_text")}, '^\s+|\s+$', '', 'g') AS t FROM tool_records), k AS (SELECT pos, CASE WHEN t = '' THEN NULL WHEN regexp_matches(lower(t), '^(usage|synopsis)([^a-z0-9_]|$)') THEN 'usage' WHEN regexp_matches(t, '^--?[A-Za-z0-9]') THEN 'option'
        WHEN regexp_matches(lower(t), '(^|[^a-z0-9_])inputs?([^a-z0-9_]|$)') THEN 'input' WHEN regexp_matches(lower(t), '(^|[^a-z0-9_])(outputs?|results?|writes?)([^a-z0-9_]|$)') THEN 'output' END AS kind FROM l)
        SELECT pos, count(*) FILTER (kind = 'usage') AS usage, count(*) FILTER (kind = 'option') AS option, count(*) FILTER (kind = 'input') AS input, count(*) FILTER (kind = 'output') AS output FROM k WHERE kind IS NOT NULL GROUP BY pos""",
    "datatype_terms": """SELECT doc_id, array_to_string(list_filter(['fasta', 'fastq', 'bam', 'sam', 'vcf', 'bed', 'gtf', 'gff3', 'csv', 'tsv', 'json', 'html', 'png'], lambda t: regexp_matches(lower(coalesce(text, '')), '(^|[^a-z0-9_])' || t || '([^a-z0-9_]|$)')), ',') AS terms FROM documents""",
    "markup_spans": r"""WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?s)<(?i:tool)[\s>/].*?</tool>') AS sp, text FROM documents WHERE doc_kind = 'wrapper_xml')
        SELECT doc_id, len(sp)::INTEGER AS spans, coalesce(length(sp[1]), 0)::INTEGER AS chars, len(string_split(coalesce(text, ''), '```')) % 2 = 0 AS open_fence FROM m""",
    "structure_score": r"""SELECT doc_id, (contains(lower(coalesce(text, '')), '<tool') ::INT * 25 + contains(lower(coalesce(text, '')), '<command')::INT * 25 + contains(lower(coalesce(text, '')), '<inputs')::INT * 20 + contains(lower(coalesce(text, '')), '<outputs')::INT * 15
        + contains(lower(coalesce(text, '')), '<tests')::INT * 10 + contains(lower(coalesce(text, '')), '<help')::INT * 5) / 100.0::DOUBLE AS score FROM documents WHERE doc_kind = 'wrapper_xml'""",
    "file_names": r"""SELECT pos, coalesce(nullif(regexp_replace(regexp_replace(tool_id, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'item') || '_' || substr(sha1(tool_id), 1, 10) AS file, regexp_replace(regexp_replace(tool_id, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
        regexp_replace(lower(tool_id), '[^a-z0-9]+', '', 'g') AS key FROM tool_records WHERE tool_id IS NOT NULL""",
    "natural_order": "SELECT c_mktsegment, min(c_custkey) AS first, max(c_custkey) AS last FROM customer GROUP BY c_mktsegment",
    "command_parts": rf"""SELECT pos, regexp_extract(container_usage_text, '(?i)usage:\s*([\w.-]+)', 1) AS program, coalesce(array_to_string(list_sort_kept, ','), '') AS subcommands FROM (SELECT pos, container_usage_text,
        list_filter(list_transform(string_split(regexp_extract(container_usage_text, '(?i)usage:\s*\S+\s*\{{([^}}]*)\}}', 1), ','), lambda x: trim(x)), lambda x, i: x <> '' AND list_position(list_transform(string_split(regexp_extract(container_usage_text, '(?i)usage:\s*\S+\s*\{{([^}}]*)\}}', 1), ','), lambda y: trim(y)), x) = i) AS list_sort_kept
        FROM tool_records WHERE {_S.format("container_usage_text")} <> '')""",
    "json_fields": "SELECT event_type, count(k) AS with_k, sum(k)::BIGINT AS total, min(k) AS least, max(k) AS most FROM (SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type",
    "combined_help": f"""WITH c AS (SELECT pos, concat_ws(chr(10) || chr(10), nullif({_S.format("help_text")}, ''), nullif({_S.format("container_help_text")}, ''), nullif({_S.format("container_usage_text")}, '')) AS c FROM tool_records)
        SELECT pos, length(c)::INTEGER AS chars, sha256(c) AS hash FROM c""",
    "option_prefixes": "WITH o AS (SELECT pos, unnest(regexp_extract_all(coalesce(container_help_text, ''), '--([a-z]+)-', 1)) AS prefix FROM tool_records) SELECT pos, prefix, count(*) AS n FROM o GROUP BY ALL HAVING count(*) >= 5",
}
