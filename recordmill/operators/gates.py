"""Declarative gates: metrics against absolute limits and a baseline, with the reasons of each failure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers


@dataclass(frozen=True)
class Gate:
    """``least`` or ``most`` bounds a metric; with a ``tolerance`` it may not fall behind a baseline by more."""

    metric: str
    least: float | None = None
    most: float | None = None
    tolerance: float | None = None


def reasons(gates: list[Gate], baseline_prefix: str = "base_") -> Column:
    """The names of the gates that fail, in order; a missing metric fails."""
    failed = []
    for g in gates:
        value = F.col(g.metric)
        if g.least is not None:
            failed.append(F.when(F.coalesce(value < g.least, F.lit(True)), f"{g.metric} is under its limit"))
        if g.most is not None:
            failed.append(F.when(F.coalesce(value > g.most, F.lit(True)), f"{g.metric} is over its limit"))
        if g.tolerance is not None:
            base = F.col(baseline_prefix + g.metric)
            worse = (value - g.tolerance > base) if g.most is not None else (value + g.tolerance < base)
            failed.append(F.when(F.coalesce(worse, F.lit(False)), f"{g.metric} fell behind the baseline"))
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def decided(metrics: DataFrame, gates: list[Gate]) -> DataFrame:
    """The metrics with ``reasons`` and ``passed``."""
    return metrics.withColumn("reasons", reasons(gates)).withColumn("passed", F.size("reasons") == 0)


def extraction_metrics(records: DataFrame, events: DataFrame, by: str) -> DataFrame:
    """Rates of each group of records: with help, with probes that succeeded, with unknown commands."""
    per = events.groupBy("pos").agg(F.bool_or(F.col("status") == "help").alias("helped"), F.bool_or(F.col("status") == "container-command-missing").alias("missing"))
    j = records.select("pos", by, F.col("help_text").isNotNull().alias("documented")).join(per, "pos", "left")
    counts = j.groupBy(by).agg(F.count("*").alias("records"), F.count_if("documented").alias("documented"), F.count_if("helped").alias("helped"), F.count_if("missing").alias("missing"))
    return counts.select(by, "records", numbers.rate("documented", "records").alias("documented_rate"), numbers.rate("helped", "records").alias("help_rate"), numbers.rate("missing", "records").alias("missing_rate"))
