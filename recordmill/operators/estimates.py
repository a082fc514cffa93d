"""Token estimates, context ladders and bounded sample lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers, text


def parse_lengths(spec: str) -> tuple[int, ...]:
    """``12k,16384,1m`` as numbers, the first of equals kept."""
    units = {"k": 1024, "m": 1024 * 1024}
    out: list[int] = []
    for part in (p.strip().lower() for p in spec.split(",")):
        if not part:
            continue
        scale = units.get(part[-1], 1)
        number = part[:-1] if scale > 1 else part
        if not number.isdigit() or int(number) <= 0:
            raise ValueError(f"not a context length: {part!r}")
        if (value := int(number) * scale) not in out:
            out.append(value)
    if not out:
        raise ValueError("no context length is given")
    return tuple(out)


def lengths_table(spark: SparkSession, spec: str) -> DataFrame:
    """(length, place) in the order given."""
    return spark.createDataFrame([(n, k) for k, n in enumerate(parse_lengths(spec))], "length long, place int")


def overflow(df: DataFrame, group: list[str], tokens: str, lengths: tuple[int, ...]) -> DataFrame:
    """(group, length, over, fit, share) for each context length: one conditional count each in one pass, then unpivoted."""
    counts = df.groupBy(*group).agg(F.count("*").alias("_n"), *[F.count_if(F.col(tokens) > n).alias(f"_over_{n}") for n in lengths])
    rows = F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("length"), F.col(f"_over_{n}").alias("over")) for n in lengths]))
    out = counts.select(*group, "_n", rows.alias("r")).select(*group, "r.length", "r.over", (F.col("_n") - F.col("r.over")).alias("fit"), "_n")
    return out.withColumn("share", numbers.rate("over", "_n")).drop("_n")


def ladder(overflows: DataFrame, group: str, most_over: int, most_share: float) -> DataFrame:
    """Context lengths within the limits, longest first: (group, length, over, share, place)."""
    from .relational import first_n

    fine = overflows.where((F.col("over") <= most_over) & (F.col("share") <= most_share))
    return first_n(fine, [group], [F.desc("length"), F.asc("over"), F.asc("share")], 1_000)


def recommended(overflows: DataFrame, group: str) -> DataFrame:
    """The smallest length that nothing overflows; null if there is none."""
    return overflows.groupBy(group).agg(F.min(F.when(F.col("over") == 0, F.col("length"))).alias("length"))


def merged_ladders(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, the primary's where keys meet."""
    both = primary.withColumn("_from", F.lit(0)).unionByName(secondary.withColumn("_from", F.lit(1)))
    from .relational import first_n

    return first_n(both, keys, [F.asc("_from")]).drop("place")


def budget_for(length: Column | str, steps: list[tuple[int, int]]) -> Column:
    """The budget of the largest step that isn't above the length; of the smallest step below all."""
    n = text.col(length)
    out = F.lit(min(steps)[1])
    for at, budget in sorted(steps):
        out = F.when(n >= at, budget).otherwise(out)
    return out


# How training texts of each task begin.
TASK_PREFIXES = [("convert", "udt_to_xml"), ("repair", "xml_repair"), ("user-defined", "udt_yaml_generate"), ("generate", "xml_generate")]


def task_of(x: Column | str) -> Column:
    """The task of a training text by its first words."""
    begin = F.lower(F.ltrim(text.filled(x)))
    out = F.lit("other")
    for prefix, task in reversed(TASK_PREFIXES):
        out = F.when(begin.startswith(prefix), task).otherwise(out)
    return out


def samples(records: DataFrame) -> DataFrame:
    """0 to 3 training samples of a record: (pos, task, instruction, chars).

    Help of either kind with a command gives a generating sample, help and container help together a
    summarizing one, and a usage text a parsing one.
    """
    help_, usage, container = (~text.blank(c) for c in ("help_text", "container_usage_text", "container_help_text"))
    named = ~text.blank("primary_command")
    body = text.combined_help("help_text", "container_help_text")
    each = F.array(
        F.when((help_ | container) & named, F.struct(F.lit("generate").alias("task"), F.concat(F.lit("Write a wrapper for "), text.stripped("primary_command")).alias("instruction"), F.length(body).alias("chars"))),
        F.when(help_ & container, F.struct(F.lit("summarize").alias("task"), F.lit("Summarize the help").alias("instruction"), F.length(body).alias("chars"))),
        F.when(usage, F.struct(F.lit("parse").alias("task"), F.lit("List the options").alias("instruction"), F.length(text.stripped("container_usage_text")).alias("chars"))),
    )
    return records.select("pos", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("s")).select("pos", "s.*")


def sample_diagnostics(records: DataFrame) -> DataFrame:
    """One row: records by which of their texts are missing or too thin to train on."""
    thin = lambda c, n: ~text.blank(c) & (F.length(text.stripped(c)) < n)
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(text.blank("primary_command")).alias("without_command"),
        F.count_if(text.blank("help_text") & text.blank("container_help_text")).alias("without_help"),
        F.count_if(thin("help_text", 80)).alias("thin_help"),
        F.count_if(F.size(F.coalesce("input_datatypes", F.array().cast("array<string>"))) == 0).alias("without_inputs"),
        F.count_if(F.size(F.coalesce("output_datatypes", F.array().cast("array<string>"))) == 0).alias("without_outputs"),
        F.count_if(F.col("is_suite_root")).alias("suite_roots"),
        F.sum(F.length(text.filled("help_text"))).alias("help_chars"),
    )


# Where feedback on a generated document may stand, and how much of it is used.
FEEDBACK_COLUMNS = ["repair_feedback", "generation_repair_feedback", "wrapper_repair_feedback", "failed_generation_feedback"]
GENERATED_CHARS, FEEDBACK_CHARS = 12_000, 4_000


def repair_samples(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(pos, items, generated, feedback): of records with feedback, how many items there are and the first.

    The columns are arrays of struct(generated, feedback); items without either text don't count.
    """
    there = [c for c in columns or FEEDBACK_COLUMNS if c in records.columns]
    if not there:
        return records.sparkSession.createDataFrame([], "pos long, items int, generated string, feedback string")
    every = F.concat(*[F.coalesce(F.col(c), F.array().cast(records.schema[c].dataType)) for c in there])
    full = F.filter(F.transform(every, lambda i: F.struct(F.substring(text.stripped(i["generated"]), 1, GENERATED_CHARS).alias("generated"), F.substring(text.stripped(i["feedback"]), 1, FEEDBACK_CHARS).alias("feedback"))), lambda i: (i["generated"] != "") & (i["feedback"] != ""))
    kept = records.select("pos", full.alias("f")).where(F.size("f") > 0)
    return kept.select("pos", F.size("f").alias("items"), F.col("f")[0]["generated"].alias("generated"), F.col("f")[0]["feedback"].alias("feedback"))
