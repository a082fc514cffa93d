"""Rates, means, token estimates and exact percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Text, col, filled

CHARS_PER_TOKEN = 3.7


def rate(part: Text, whole: Text) -> Column:
    """part / whole, 0 where whole isn't positive; unrounded."""
    return F.when(col(whole) > 0, col(part) / col(whole)).otherwise(0.0)


def mean(x: Text) -> Column:
    return F.coalesce(F.avg(col(x)), F.lit(0.0))


def token_estimate(x: Text, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    """At least one token; characters by a ratio, rounded up."""
    return F.greatest(F.lit(1), F.ceil(F.length(filled(x)) / F.lit(chars_per_token))).cast("long")


def jaccard(a: Text, b: Text) -> Column:
    """Shared over all members; two empty sets are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def interpolated(lower: Text, upper: Text, position: Column) -> Column:
    """Between two order statistics, rounded half to even."""
    low, high = col(lower).cast("double"), col(upper).cast("double")
    return F.bround(low + (high - low) * (position - F.floor(position))).cast("long")


def summary(df: DataFrame, group: str, value: str, points: tuple[int, ...] = (50, 90, 95, 99)) -> DataFrame:
    """(group, n, least, p.., most, mean) with exact percentiles of a long column.

    Order statistics are picked from the sorted distinct values' running counts, so a group's values are
    never gathered: the largest exchange is one row for each group and distinct value.
    """
    from pyspark.sql.window import Window

    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("times"))
    by_group = Window.partitionBy(group)
    up_to = F.sum("times").over(by_group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumns({"upto": up_to, "n": F.sum("times").over(by_group)})
    place = {p: (F.col("n") - 1) * (p / 100) for p in points}
    first = F.col("upto") - F.col("times")
    holds = lambda k: (first <= k) & (k < F.col("upto"))
    picks = []
    for p, at in place.items():
        picks.append(F.max(F.when(holds(F.floor(at)), F.col(value))).alias(f"lo{p}"))
        picks.append(F.max(F.when(holds(F.least(F.floor(at) + 1, F.col("n") - 1)), F.col(value))).alias(f"hi{p}"))
    out = ranked.groupBy(group).agg(F.max("n").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.sum(F.col(value) * F.col("times")).alias("total"), *picks)
    points_out = [interpolated(f"lo{p}", f"hi{p}", (F.col("n") - 1) * (p / 100)).alias(f"p{p}") for p in points]
    return out.select(group, "n", "least", *points_out, "most", (F.col("total") / F.col("n")).alias("mean"))
