"""Queries over sub-commands, image names, sources, snippets and conversions, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import convert, documents, markup, text
from ..operators import extraction
from .tables import table


def bundle_names(s, d):  # noqa: ANN001, ANN201
    """The image name of each record's requirements."""
    r = table(s, d, "tool_records").where(F.size(F.coalesce("requirement_versions", F.create_map().cast("map<string,string>"))) > 0)
    return r.select("pos", documents.bundle_name("requirement_versions", "0").alias("image"))


def source_fallbacks(s, d):  # noqa: ANN001, ANN201
    """Other places for sources that failed."""
    m = table(s, d, "source_mappings").where(~text.blank("source_url") & ~text.blank("source_error"))
    return m.select("mapping_id", "source_url", F.explode_outer(documents.fallback_urls("source_url")).alias("f")).select("mapping_id", F.coalesce("f.url", "source_url").alias("url"), F.coalesce("f.reason", F.lit("none")).alias("reason"))


def suite_plans(s, d):  # noqa: ANN001, ANN201
    """Commands that each record's usage text would make a suite of."""
    r = table(s, d, "tool_records").where(~text.blank("container_usage_text") & ~text.blank("primary_command"))
    return r.select("pos", F.posexplode(documents.plans("primary_command", "container_usage_text")).alias("place", "command"))


def usage_subcommands(s, d):  # noqa: ANN001, ANN201
    r = table(s, d, "tool_records")
    return r.select("pos", F.array_join(documents.usage_subcommands("container_help_text"), ",").alias("subcommands")).where("subcommands <> ''")


def usage_snippets(s, d):  # noqa: ANN001, ANN201
    """Places that show usage in container help."""
    t = table(s, d, "tool_records").where(~text.blank("container_help_text"))
    return t.select("pos", F.explode(documents.usage_snippets("container_help_text")).alias("u")).select("pos", "u.line", F.length("u.text").alias("chars"))


def converted_wrappers(s, d):  # noqa: ANN001, ANN201
    """Wrappers as YAML and back: whether each way worked and how many notes there were."""
    w = table(s, d, "documents").where("doc_kind = 'wrapper_xml'").select("doc_id", convert.to_yaml("text").alias("y"))
    return w.select("doc_id", F.col("y").isNotNull().alias("converted"), convert.to_xml("y").alias("x")).select("doc_id", "converted", F.col("x.text").isNotNull().alias("back"), F.size("x.notes").alias("notes"))


def finished_wrappers(s, d):  # noqa: ANN001, ANN201
    """Wrappers with an id from their document and one test left."""
    w = table(s, d, "documents").where("doc_kind = 'wrapper_xml'")
    return w.select("doc_id", convert.finish("text", F.concat(F.lit("tool_"), F.col("doc_id").cast("string")), "package_id").alias("f")).select("doc_id", "f.removed", "f.changed")


def script_calls(s, d):  # noqa: ANN001, ANN201
    """Calls of imported names and of R packages in documents."""
    t = table(s, d, "documents").where("text IS NOT NULL").select("doc_id", documents.calls("text").alias("p"), documents.r_calls("text").alias("r"))
    return t.select("doc_id", F.size("p").alias("python_calls"), F.size("r").alias("r_calls"))


def extracted_records(s, d):  # noqa: ANN001, ANN201
    """Wide records of the wrappers among the documents."""
    r = extraction.records(table(s, d, "documents").where("doc_kind = 'wrapper_xml'"), "doc_id", "text")
    return r.select("id", "tool_id", "version", F.length("help").alias("help_chars"), F.array_join("programs", ",").alias("programs"), F.size("packages").alias("packages"), F.array_join("datatypes", ",").alias("datatypes"), "inputs", "outputs", "score", "well_formed")


def wrapper_identity(s, d):  # noqa: ANN001, ANN201
    """Id, name and version in the start tags of the wrappers."""
    return extraction.records(table(s, d, "documents").where("doc_kind = 'wrapper_xml'"), "doc_id", "text").select("id", "tool_id", "tool_name", "version")


def wrapper_failures(s, d):  # noqa: ANN001, ANN201
    """Why wrappers fail, and how many of them."""
    w = table(s, d, "documents").where("doc_kind = 'wrapper_xml'").select(markup.xml_features("text").alias("f"), markup.diagnostics("text").alias("g"))
    why = extraction.failure_of(F.col("g"), F.col("f.well_formed"), F.col("f.root") == "tool", F.lit(0))
    return w.select(why.alias("w")).groupBy(F.coalesce("w.error", F.lit("none")).alias("error"), F.col("w.cut").alias("cut")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (bundle_names, source_fallbacks, suite_plans, usage_subcommands, usage_snippets, converted_wrappers, finished_wrappers, script_calls, extracted_records, wrapper_identity, wrapper_failures)}

ORACLES = {
    "bundle_names": """WITH e AS (SELECT pos, list_sort(map_entries(requirement_versions)) AS es FROM tool_records WHERE len(map_keys(requirement_versions)) > 0),
        n AS (SELECT pos, list_transform(es, lambda e: e.key) AS ks, list_transform(es, lambda e: coalesce(e.value, '')) AS vs FROM e)
        SELECT pos, CASE WHEN len(ks) = 1 THEN ks[1] || CASE WHEN vs[1] <> '' THEN ':' || vs[1] ELSE '' END ELSE 'mulled-v2-' || sha1(array_to_string(ks, chr(10))) || ':' || CASE WHEN len(list_filter(vs, lambda v: v <> '')) > 0
            THEN sha1(array_to_string(list_transform(vs, lambda v: CASE WHEN v = '' THEN 'null' ELSE v END), chr(10))) || '-0' ELSE '0' END END AS image FROM n""",
    "source_fallbacks": r"""WITH m AS (SELECT mapping_id, regexp_replace(source_url, '^\s+|\s+$', '', 'g') AS u FROM source_mappings WHERE trim(coalesce(source_url, '')) <> '' AND trim(coalesce(source_error, '')) <> '')
        SELECT mapping_id, CASE WHEN contains(u, ' ') THEN replace(u, ' ', '%20') ELSE u END AS url, CASE WHEN contains(u, ' ') THEN 'encoded' ELSE 'none' END AS reason FROM m""",
    "wrapper_identity": r"""WITH t AS (SELECT doc_id AS id, regexp_extract(coalesce(text, ''), '(?is)<tool\b([^>]*)>', 1) AS r FROM documents WHERE doc_kind = 'wrapper_xml')
        SELECT id, regexp_extract(r, '\bid\s*=\s*["'']([^"'']*)["'']', 1) AS tool_id, regexp_extract(r, '\bname\s*=\s*["'']([^"'']*)["'']', 1) AS tool_name, regexp_extract(r, '\bversion\s*=\s*["'']([^"'']*)["'']', 1) AS version FROM t""",
    "usage_subcommands": r"""WITH h AS (SELECT pos, unnest(regexp_extract_all(coalesce(container_help_text, ''), '(?i)usage:\s*\S+[^\n{]*\{([^}]*)\}', 1)) AS g, generate_subscripts(regexp_extract_all(coalesce(container_help_text, ''), '(?i)usage:\s*\S+[^\n{]*\{([^}]*)\}', 1), 1) AS a FROM tool_records),
        p AS (SELECT pos, a, trim(unnest(string_split(g, ','))) AS n, generate_subscripts(string_split(g, ','), 1) AS b FROM h), f AS (SELECT pos, a, b, n FROM p WHERE n <> '' AND lower(n) NOT IN ('help', 'version', 'completion', 'usage', 'options') QUALIFY row_number() OVER (PARTITION BY pos, lower(n) ORDER BY a, b) = 1)
        SELECT pos, string_agg(n, ',' ORDER BY a, b) AS subcommands FROM f GROUP BY pos""",
}
