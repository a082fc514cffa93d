"""Splits that keep related records together: union-find over shared keys, then largest-first assignment.

Records are related if they share any of several normalized keys, directly or through other records.
Groups go, largest first, to the split furthest below its target share.

Cases: null, blank and stand-in keys relate nothing; a record without keys is a group of its own;
repeated rows share their keys and so their split; ties go to the split named first; no rows give no
rows; other columns of the input aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .components import connected_components

TARGETS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
_RANK_PARTS = 1024


def groups(records: DataFrame, id_col: str, keys: dict[str, Column]) -> DataFrame:
    """(id, root) for every row; root is the smallest node ``key name:value`` of its group, null for a row without keys."""
    names = list(keys)
    nodes = [F.concat(F.lit(f"{n}:"), F.col(n)) for n in names]
    rows = records.select(F.col(id_col).alias("id"), *[keys[n].alias(n) for n in names])
    # A chain through a row's keys links them all; a row with one key gives that node an edge to itself.
    rows = rows.withColumn("nodes", F.filter(F.array(*nodes), lambda x: x.isNotNull()))
    rows = written(rows.select("id", "nodes"), "row-keys")
    links = rows.where(F.size("nodes") > 0).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("nodes") - 1, F.lit(1))), lambda i: F.struct(F.element_at("nodes", i).alias("a"), F.coalesce(F.try_element_at("nodes", i + 1), F.element_at("nodes", i)).alias("b")))).alias("e")
    )
    roots = connected_components(links.select("e.a", "e.b"))
    anchored = rows.withColumn("node", F.try_element_at("nodes", F.lit(1))).select("id", "node")
    return anchored.join(written(roots, "roots"), "node", "left").select("id", "node", "root")


def related(records: DataFrame, id_col: str, keys: dict[str, Column], name_key: str) -> DataFrame:
    """(id, group_key) of the rows related to another row; group_key is the smallest ``name_key`` value in the group."""
    rows = written(groups(records, id_col, keys), "grouped")
    sizes = rows.where("root IS NOT NULL").groupBy("root").agg(F.count("*").alias("rows")).where("rows > 1")
    named = records.select(F.col(id_col).alias("id"), keys[name_key].alias("name")).where("name IS NOT NULL")
    least = rows.join(named, "id").groupBy("root").agg(F.min("name").alias("group_key"))
    return rows.join(sizes.join(least, "root", "left"), "root").select("id", "group_key")


def greedy_plan(histogram: list[tuple[int, int]], targets: tuple[tuple[str, float], ...] = TARGETS) -> list[tuple[int, str, int]]:
    """(group size, split, number of groups), in assigning order, from (size, number of groups) pairs.

    The same as giving out single groups largest first, each to the split furthest below its target
    share; runs of equal groups are given out in bulk, so the work follows the number of distinct
    sizes, which is at most the square root of twice the number of rows.
    """
    total = sum(size * n for size, n in histogram)
    have = {name: 0 for name, _ in targets}
    goal = {name: share * total for name, share in targets}
    order = {name: k for k, (name, _) in enumerate(targets)}
    plan: list[tuple[int, str, int]] = []
    for size, n in sorted(histogram, reverse=True):
        while n:
            ranked = sorted(goal, key=lambda s: (have[s] - goal[s], order[s]))
            first, second = ranked[0], ranked[1] if len(ranked) > 1 else ranked[0]
            lead = (goal[first] - have[first]) - (goal[second] - have[second])
            bulk = max(1, min(n, int(lead // size)))
            plan.append((size, first, bulk))
            have[first] += bulk * size
            n -= bulk
    return plan


def assign(records: DataFrame, id_col: str, keys: dict[str, Column], targets: tuple[tuple[str, float], ...] = TARGETS) -> DataFrame:
    """(id, group_root, split) for every row."""
    spark = records.sparkSession
    rows = groups(records, id_col, keys).withColumn("unit", F.coalesce("root", F.concat(F.lit("row:"), F.col("id").cast("string"))))
    rows = written(rows.select("id", "unit"), "units")
    sizes = rows.groupBy("unit").agg(F.count("*").alias("size")).withColumn("part", F.pmod(F.xxhash64("unit"), F.lit(_RANK_PARTS)))
    sizes = written(sizes, "unit-sizes")
    histogram = [(r["size"], r["n"]) for r in sizes.groupBy("size").agg(F.count("*").alias("n")).collect()]  # at most sqrt(2 rows) lines
    runs: list[tuple[int, str, int, int]] = []
    at: dict[int, int] = {}
    for size, split, n in greedy_plan(histogram, targets):
        lo = at.get(size, 0)
        if runs and runs[-1][:2] == (size, split):
            runs[-1] = (size, split, runs[-1][2], lo + n)
        else:
            runs.append((size, split, lo, lo + n))
        at[size] = lo + n
    # Rank of a unit among those of its size: an offset of its part, from counts, and its place in the part.
    counts = sizes.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = counts.select("size", "part", (F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")).alias("offset"))
    place = F.row_number().over(Window.partitionBy("size", "part").orderBy("unit")) - 1
    ranked = sizes.withColumn("place", place).join(before, ["size", "part"]).select("unit", "size", (F.col("place") + F.col("offset")).alias("rank"))
    spans = spark.createDataFrame(runs or [(0, "", 0, 0)], "size long, split string, lo long, hi long")
    chosen = ranked.join(spans.groupBy("size").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "split"))).alias("spans")), "size")
    chosen = chosen.select("unit", F.filter("spans", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"]))[0]["split"].alias("split"))
    return rows.join(chosen, "unit").select("id", F.col("unit").alias("group_root"), "split")


def split_shares(assigned: DataFrame) -> DataFrame:
    """(split, rows, share) of an assignment."""
    counts = assigned.groupBy("split").agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))  # one row a split
