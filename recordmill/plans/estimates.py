"""Queries of token estimates and training samples, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators import estimates, relational
from .tables import table

LENGTHS = "128,256,512,1k"


def _documents(s, d):  # noqa: ANN001, ANN202
    return table(s, d, "documents").withColumn("tokens", numbers.token_estimate("text"))


def token_summary_by_source(s, d):  # noqa: ANN001, ANN201
    return numbers.summary(_documents(s, d).select("source", "tokens"), "source", "tokens")


def token_overflow(s, d):  # noqa: ANN001, ANN201
    return estimates.overflow(_documents(s, d), ["lang"], "tokens", estimates.parse_lengths(LENGTHS))


def ladder_candidates(s, d):  # noqa: ANN001, ANN201
    return estimates.ladder(token_overflow(s, d), "lang", 500, 0.5).select("lang", "length", "over", "share", "place")


def recommended_length(s, d):  # noqa: ANN001, ANN201
    return estimates.recommended(estimates.overflow(_documents(s, d), ["source"], "tokens", estimates.parse_lengths("256,512,1k,2k,4k")), "source")


def merged_ladder(s, d):  # noqa: ANN001, ANN201
    docs = _documents(s, d)
    mine = estimates.overflow(docs.where("doc_kind = 'readme'"), ["lang"], "tokens", (256, 512))
    other = estimates.overflow(docs, ["lang"], "tokens", (512, 1024))
    return estimates.merged_ladders(mine, other, ["lang", "length"]).select("lang", "length", "over", "fit")


def longest_samples(s, d):  # noqa: ANN001, ANN201
    """The 25 longest documents, all ties broken."""
    docs = _documents(s, d).select("doc_id", "tokens", "n_chars", "source", "package_id")
    top = docs.orderBy(F.desc("tokens"), F.desc_nulls_last("n_chars"), F.desc_nulls_last("source"), F.desc("doc_id")).limit(25)
    return top.select("doc_id", "tokens", "source")


def document_tasks(s, d):  # noqa: ANN001, ANN201
    """Documents by how they begin."""
    begin = F.lower(F.regexp_extract(text.filled("text"), r"^\s*(\S{1,20})", 1))
    kind = F.when(begin.startswith("<tool"), "xml").when(begin.startswith("class:"), "yaml").when(begin.startswith("#"), "heading").when(begin.startswith("usage"), "usage").when(begin.startswith("["), "log").when(begin == "", "empty").otherwise("prose")
    return _documents(s, d).groupBy("doc_kind", kind.alias("begins")).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))


def training_samples(s, d):  # noqa: ANN001, ANN201
    """Samples of each task, with the split that their record is in."""
    samples = estimates.samples(table(s, d, "tool_records"))
    split = table(s, d, "split_members").select("pos", F.lower(text.stripped("split")).alias("split")).distinct()
    return samples.join(split, "pos").groupBy("task", "split").agg(F.count("*").alias("samples"), F.sum("chars").cast("long").alias("chars"), F.max("chars").alias("longest"))


def sample_diagnostics(s, d):  # noqa: ANN001, ANN201
    return estimates.sample_diagnostics(table(s, d, "tool_records"))


def train_valid(s, d):  # noqa: ANN001, ANN201
    """The first twentieth of the records in input order, 1 to 100 of them, for validation; the rest for training."""
    r = relational.positions(table(s, d, "tool_records").select("pos", "package_id"), "pos")
    n = table(s, d, "tool_records").agg(F.count("*").alias("n"))
    size = F.least(F.greatest(F.lit(1), F.floor(F.col("n") / 20)), F.lit(100))
    return r.crossJoin(F.broadcast(n)).select("pos", F.when(F.col("index") < size, "valid").otherwise("train").alias("part"))  # one row is broadcast


def shards(s, d):  # noqa: ANN001, ANN201
    """Records dealt out in turn."""
    return relational.round_robin(table(s, d, "tool_records").select("pos"), "pos", 4).select("pos", "index", "shard")


def packed_texts(s, d):  # noqa: ANN001, ANN201
    """Documents of each package that fit its budget of characters, in order; the last one in part."""
    docs = table(s, d, "documents").where("package_id IS NOT NULL AND n_chars IS NOT NULL").select("doc_id", "package_id", "n_chars")
    fit = relational.within_budget(docs, ["package_id"], "doc_id", F.col("n_chars"), 4000)
    return fit.select("package_id", "doc_id", F.least("n_chars", "room").alias("chars"))


def context_budgets(s, d):  # noqa: ANN001, ANN201
    """Each document's budget by its length class and how much of it is left."""
    steps = [(0, 200), (512, 400), (1024, 900), (4096, 2000)]
    b = _documents(s, d).withColumn("budget", estimates.budget_for("n_chars", steps).cast("long"))
    return b.groupBy("budget").agg(F.count("*").alias("documents"), F.sum(F.least("tokens", "budget")).alias("used"))


QUERIES = {f.__name__: f for f in (token_summary_by_source, token_overflow, ladder_candidates, recommended_length, merged_ladder, longest_samples, document_tasks, training_samples, sample_diagnostics, train_valid, shards, packed_texts, context_budgets)}

_TOK = "greatest(1, ceil(length(coalesce(text, '')) / 3.7::DOUBLE))::BIGINT"
_P = "round_even(quantile_disc(t, {0}), 0)"
_STAT = "(list_extract(l, floor((n - 1) * {0})::BIGINT + 1) + (list_extract(l, least(floor((n - 1) * {0})::BIGINT + 2, n)) - list_extract(l, floor((n - 1) * {0})::BIGINT + 1)) * ((n - 1) * {0} - floor((n - 1) * {0})))"
_OVER = "SELECT {0}, len AS length, count(*) FILTER (t > len) AS over, count(*) FILTER (t <= len) AS fit, (count(*) FILTER (t > len))::DOUBLE / count(*) AS share FROM (SELECT *, " + _TOK + " AS t FROM documents {2}), (SELECT unnest([{1}]::BIGINT[]) AS len) GROUP BY {0}, len"
_S = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
_BODY = f"length(concat_ws(chr(10) || chr(10), nullif({_S.format('help_text')}, ''), nullif({_S.format('container_help_text')}, '')))"

ORACLES = {
    "token_summary_by_source": f"""WITH g AS (SELECT source, list_sort(list({_TOK}::DOUBLE)) AS l, count(*) AS n, min({_TOK}) AS least, max({_TOK}) AS most, sum({_TOK})::DOUBLE AS total FROM documents GROUP BY source)
        SELECT source, n, least, round_even({_STAT.format("(50::DOUBLE / 100)")}, 0)::BIGINT AS p50, round_even({_STAT.format("(90::DOUBLE / 100)")}, 0)::BIGINT AS p90, round_even({_STAT.format("(95::DOUBLE / 100)")}, 0)::BIGINT AS p95,
        round_even({_STAT.format("(99::DOUBLE / 100)")}, 0)::BIGINT AS p99, most, total / n AS mean FROM g""",
    "token_overflow": _OVER.format("lang", "128, 256, 512, 1024", ""),
    "ladder_candidates": f"WITH o AS ({_OVER.format('lang', '128, 256, 512, 1024', '')}) SELECT lang, length, over, share, row_number() OVER (PARTITION BY lang ORDER BY length DESC, over, share)::INTEGER AS place FROM o WHERE over <= 500 AND share <= 0.5",
    "recommended_length": f"WITH o AS ({_OVER.format('source', '256, 512, 1024, 2048, 4096', '')}) SELECT source, min(length) FILTER (over = 0) AS length FROM o GROUP BY source",
    "merged_ladder": f"""WITH a AS ({_OVER.format("lang", "256, 512", "WHERE doc_kind = 'readme'")}), b AS ({_OVER.format("lang", "512, 1024", "")})
        SELECT lang, length, over, fit FROM a UNION ALL SELECT lang, length, over, fit FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.lang IS NOT DISTINCT FROM b.lang AND a.length = b.length)""",
    "longest_samples": f"SELECT doc_id, {_TOK} AS tokens, source FROM documents ORDER BY tokens DESC, n_chars DESC NULLS LAST, source DESC NULLS LAST, doc_id DESC LIMIT 25",
    "document_tasks": rf"""WITH b AS (SELECT doc_kind, {_TOK} AS t, lower(regexp_extract(coalesce(text, ''), '^\s*(\S{{1,20}})', 1)) AS b FROM documents)
        SELECT doc_kind, CASE WHEN b LIKE '<tool%' THEN 'xml' WHEN b LIKE 'class:%' THEN 'yaml' WHEN b LIKE '#%' THEN 'heading' WHEN b LIKE 'usage%' THEN 'usage' WHEN b LIKE '[%' THEN 'log' WHEN b = '' THEN 'empty' ELSE 'prose' END AS begins,
        count(*) AS documents, sum(t)::BIGINT AS tokens FROM b GROUP BY ALL""",
    "training_samples": f"""WITH r AS (SELECT pos, {_S.format("help_text")} <> '' AS h, {_S.format("container_usage_text")} <> '' AS u, {_S.format("container_help_text")} <> '' AS c, {_S.format("primary_command")} <> '' AS p, {_BODY} AS body, length({_S.format("container_usage_text")}) AS ul FROM tool_records),
        x AS (SELECT pos, 'generate' AS task, body AS chars FROM r WHERE (h OR c) AND p UNION ALL SELECT pos, 'summarize', body FROM r WHERE h AND c UNION ALL SELECT pos, 'parse', ul FROM r WHERE u),
        m AS (SELECT DISTINCT pos, lower({_S.format("split")}) AS split FROM split_members) SELECT task, split, count(*) AS samples, sum(chars)::BIGINT AS chars, max(chars)::INTEGER AS longest FROM x JOIN m USING (pos) GROUP BY ALL""",
    "sample_diagnostics": f"""SELECT count(*) AS records, count(*) FILTER ({_S.format("primary_command")} = '') AS without_command, count(*) FILTER ({_S.format("help_text")} = '' AND {_S.format("container_help_text")} = '') AS without_help,
        count(*) FILTER ({_S.format("help_text")} <> '' AND length({_S.format("help_text")}) < 80) AS thin_help, count(*) FILTER (coalesce(len(input_datatypes), 0) = 0) AS without_inputs, count(*) FILTER (coalesce(len(output_datatypes), 0) = 0) AS without_outputs,
        count(*) FILTER (is_suite_root) AS suite_roots, sum(length(coalesce(help_text, '')))::BIGINT AS help_chars FROM tool_records""",
    "train_valid": "SELECT pos, CASE WHEN row_number() OVER (ORDER BY pos) <= least(greatest(1, count(*) OVER () // 20), 100) THEN 'valid' ELSE 'train' END AS part FROM tool_records",
    "shards": "SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS index, ((row_number() OVER (ORDER BY pos) - 1) % 4)::INTEGER AS shard FROM tool_records",
    "packed_texts": "WITH u AS (SELECT package_id, doc_id, n_chars, 4000 - sum(n_chars) OVER (PARTITION BY package_id ORDER BY doc_id) + n_chars AS room FROM documents WHERE package_id IS NOT NULL AND n_chars IS NOT NULL) SELECT package_id, doc_id, least(n_chars, room)::BIGINT AS chars FROM u WHERE room > 0",
    "context_budgets": f"WITH b AS (SELECT {_TOK} AS t, CASE WHEN n_chars >= 4096 THEN 2000 WHEN n_chars >= 1024 THEN 900 WHEN n_chars >= 512 THEN 400 ELSE 200 END::BIGINT AS budget FROM documents) SELECT budget, count(*) AS documents, sum(least(t, budget))::BIGINT AS used FROM b GROUP BY budget",
}
