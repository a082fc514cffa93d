"""Distributed union-find: local forests, merged level by level.

Every partition links its edges in a local forest and passes on one edge for each node that isn't a
root, so what is shuffled is bounded by nodes, not by edges, and a key that a third of all rows share
costs each partition one edge. Forests then merge: while more edges are left than one task should
hold, a level ties every node's neighbours to the smallest of them, from above and from below, and links
again inside each part; the last level, of proven size, links in one task.
Nothing is collected to the driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


class Forest:
    """Union-find with the smallest node as root."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while (up := parent[x]) != root:
            parent[x] = root
            x = up
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            if b < a:
                a, b = b, a
            self.parent[b] = a


def _forest_of(batches: Iterator[pa.RecordBatch], limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Edges in, edges (node, root) of the local forest out; a forest of ``limit`` nodes is emitted and begun anew."""
    forest = Forest()
    schema = None

    def edges() -> Iterator[pa.RecordBatch]:
        nodes = list(forest.parent)
        for k in range(0, len(nodes), 50_000):
            part = nodes[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, schema.field(0).type), pa.array([forest.find(x) for x in part], schema.field(1).type)], names=["node", "root"])

    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.union(a, b)
        if len(forest.parent) > limit:
            yield from edges()
            forest = Forest()
    if schema is not None and forest.parent:
        yield from edges()


def connected_components(edges: DataFrame, one_task_edges: int = 1_000_000, max_levels: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns of one type); root is the component's smallest node.

    A row with equal ends makes a node of its own; rows with a null end are ignored; no rows give no rows.
    """
    a, b = edges.columns[:2]
    kind = edges.schema[a].dataType.simpleString()
    shape = f"node {kind}, root {kind}"
    forest = edges.select(F.col(a).alias("node"), F.col(b).alias("root")).where("node IS NOT NULL AND root IS NOT NULL").mapInArrow(_forest_of, shape)
    level = written(forest, "forest-0")
    if level.count() <= one_task_edges:
        return level.coalesce(1).mapInArrow(_forest_of, shape)
    nodes = level.select("node").union(level.select("root")).distinct()
    level = level.where("node <> root")
    for k in range(1, max_levels):
        # Every node's larger neighbours are tied to its smallest neighbour ...
        both = level.union(level.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.join(low, "node").where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        # ... then its smaller ones and itself.
        least = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(least, "node").where("root <> low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        merged = small.union(least.select("node", F.col("low").alias("root"))).distinct()
        level = written(merged.mapInArrow(_forest_of, shape).where("node <> root").distinct(), f"forest-{k}")
        several = level.groupBy("node").count().where("count > 1")
        if several.isEmpty() and level.join(level.select(F.col("node").alias("root")), "root", "left_semi").isEmpty():
            return nodes.join(level, "node", "left").select("node", F.coalesce("root", "node").alias("root"))  # stars
        if level.count() <= one_task_edges:
            stars = written(level.coalesce(1).mapInArrow(_forest_of, shape), "stars")
            return nodes.join(stars, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    raise RuntimeError(f"components didn't settle in {max_levels} levels")
