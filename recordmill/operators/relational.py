"""General record operators: frequency tables, first-of-group, merges, resume joins, comparisons, roll-ups.

All are DataFrame -> DataFrame, without collecting. Where order matters it is given by columns, never by the
order in which rows happen to arrive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written


def frequencies(df: DataFrame, *keys: str, count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count))


def ranked_frequencies(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """(key, n, place): count descending, key ascending. ``top`` keeps so many and ranks after aggregating."""
    counts = frequencies(df, key)
    if top is not None:
        counts = counts.orderBy(F.desc("n"), F.asc(key)).limit(top)
        return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(key))))  # ``top`` rows
    return counts


def first_n(df: DataFrame, by: list[str], order: list[Column], n: int = 1, place: str = "place") -> DataFrame:
    """The first ``n`` rows of each group; Spark keeps ``n`` of each group before the exchange."""
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(place) <= n)


def last_wins(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Of each key the row with the largest ``order``, pre-aggregated before the exchange."""
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*by, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def first_wins(df: DataFrame, by: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*by, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the done ones."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def wanted(rows: DataFrame, keys: DataFrame, key: str, alternatives: list[str]) -> DataFrame:
    """Rows of which any of several columns is among the keys; equal rows stay as many as they were.

    The keys are distinct, so each alternative's join adds no row; a null is never among the keys.
    """
    ids = keys.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    hit = rows
    for k, c in enumerate(alternatives):
        found = ids.select(F.col("_key").alias(f"_key{k}"), F.lit(True).alias(f"_hit{k}"))
        hit = hit.join(found, F.col(c) == F.col(f"_key{k}"), "left").drop(f"_key{k}")
    marks = [f"_hit{k}" for k in range(len(alternatives))]
    return hit.where(F.coalesce(*marks, F.lit(False))).drop(*marks)


def compared(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, in_left, in_right, changed): a full outer join; ``changed`` names the columns that differ, nulls being equal."""
    a = left.select(key, F.lit(True).alias("in_left"), *[F.col(c).alias(f"l_{c}") for c in columns])
    b = right.select(key, F.lit(True).alias("in_right"), *[F.col(c).alias(f"r_{c}") for c in columns])
    both = a.join(b, key, "full_outer").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")})
    differ = [F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), F.lit(c)) for c in columns]
    changed = F.when(F.col("in_left") & F.col("in_right"), F.filter(F.array(*differ), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    return both.select(key, "in_left", "in_right", changed.alias("changed"))


def comparison_counts(comparison: DataFrame) -> DataFrame:
    both, changed = F.col("in_left") & F.col("in_right"), F.size("changed") > 0
    return comparison.agg(
        F.count("*").alias("keys"),
        F.count_if("in_left").alias("left_rows"),
        F.count_if("in_right").alias("right_rows"),
        F.count_if(both).alias("in_both"),
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("only_left"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("only_right"),
        F.count_if(both & changed).alias("changed_rows"),
    )


def worst_status(status: str, ranking: list[str], default: str) -> Column:
    """The status that comes first in ``ranking`` among a group's; the default if none of them does."""
    rank = F.coalesce(*[F.when(F.col(status) == s, k) for k, s in enumerate(ranking)])
    names = F.array(*[F.lit(s) for s in ranking])
    return F.coalesce(F.try_element_at(names, (F.min(rank) + 1).cast("int")), F.lit(default))


def job_state(status: str) -> Column:
    """failed if any is, completed if all are, else running."""
    return F.when(F.bool_or(F.col(status) == "failed"), "failed").when(F.bool_and(F.col(status) == "completed"), "completed").otherwise("running")


def ordinal_names(df: DataFrame, by: list[str], name: str, order: str, out: str = "unique_name") -> DataFrame:
    """Names repeated in a group get the suffixes _2, _3, ..."""
    k = F.row_number().over(Window.partitionBy(*by, name).orderBy(order))
    return df.withColumn(out, F.when(k == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), k)))


def positions(df: DataFrame, order: str, out: str = "index", parts: int = 64) -> DataFrame:
    """0-based position by a unique order column, without sorting into one task: sizes of ranges are summed.

    The ranged rows are written once with the number of their range. Ranges are found by sampling, so two plans
    over the same frame may cut it differently; sizes and places have to come from one cut.
    """
    ranged = written(df.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).select("_part", "_before")  # ``parts`` rows
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    placed = ranged.withColumn("_within", within).join(F.broadcast(before), "_part")  # ``parts`` rows
    return placed.withColumn(out, (F.col("_before") + F.col("_within")).cast("long")).drop("_part", "_before", "_within")


def round_robin(df: DataFrame, order: str, shards: int) -> DataFrame:
    return positions(df, order).withColumn("shard", F.pmod("index", F.lit(shards)).cast("int"))


def within_budget(df: DataFrame, by: list[str], order: str, size: Column, budget: int) -> DataFrame:
    """Rows of each group whose running size stays within the budget; ``room`` is what was left before each."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = df.withColumn("used", F.sum(size).over(w)).withColumn("room", F.lit(budget) - F.col("used") + size)
    return used.where(F.col("room") > 0)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
