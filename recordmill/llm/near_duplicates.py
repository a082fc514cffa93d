"""Near-duplicate records: SuperMinHash signatures, banding, exact verification, union-find groups.

Cases: a null text counts as empty; texts under ``min_words`` words are in no pair and no group; very
long texts are taken whole; copies of one word sequence share one signature and stand for each other;
repeated rows are rows like any other; no rows give no rows; other columns of the input aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import spread, written
from .components import connected_components
from .superminhash import packed, signatures
from .words import WordHashes, content_keys, gram_hashes, hashed_words, slices

#: 48 bands of 4 places: a pair of likeness 0.6 shares no band once in 780 times, one of 0.65 once in 12,000.
BANDS, ROWS = 48, 4
SIG_SCHEMA = "id long, key binary, n int, sig binary"


def _sign(bands: int, rows: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                part = batch.slice(lo, hi - lo)
                flat, offsets = hashed_words(texts[lo:hi], hashes)
                keys = content_keys(flat, offsets)
                first: dict[bytes, int] = {}
                of = [first.setdefault(key, i) for i, key in enumerate(keys)]  # copies in the batch are signed once
                own, grams = gram_hashes(flat, offsets, shingle)
                alone = np.zeros(len(keys), bool)
                alone[list(first.values())] = True
                keep = alone[own]
                own, grams = own[keep], grams[keep]
                n = np.bincount(own, minlength=len(keys))
                number = np.cumsum(alone) - 1
                sig = packed(signatures(number[own], grams, int(alone.sum()), bands * rows))
                rows_of = number[np.array(of, np.int64)] if of else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(n[of].astype(np.int32) if of else [], pa.int32()), pa.array([sig[i].tobytes() for i in rows_of], pa.binary())],
                    names=["id", "key", "n", "sig"],
                )

    return run


def _grams(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                flat, offsets = hashed_words(texts[lo:hi], hashes)
                own, grams = gram_hashes(flat, offsets, shingle)
                ends = np.searchsorted(own, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams.view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), lists], names=["id", "grams"])

    return run


def _agree(bits: int):
    """Share of equal places of two packed signatures."""

    @F.pandas_udf("float")
    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return a.astype("float32")
        x = np.frombuffer(b"".join(a), np.uint16).reshape(len(a), bits)
        y = np.frombuffer(b"".join(b), np.uint16).reshape(len(b), bits)
        return pd.Series((x == y).mean(axis=1, dtype=np.float32))

    return agree


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


class NearDuplicates:
    """The stages over one table; each is computed once and written to the shared folder.

    ``texts`` has an id (unique, long) and a text; ids whose ``eligible`` column is false were removed before.
    """

    def __init__(self, texts: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, shingle: int = 5, bands: int = BANDS, rows: int = ROWS) -> None:
        self.texts = texts.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id IS NOT NULL")
        self.threshold, self.shingle, self.bands, self.rows = threshold, shingle, bands, rows
        signed = written(spread(self.texts).mapInArrow(_sign(bands, rows, shingle), SIG_SCHEMA), "signatures")
        #: id, key; rep: the smallest id with the same word sequence.
        reps = signed.groupBy("key").agg(F.min("id").alias("rep"))
        self.members = written(signed.select("id", "key").join(reps, "key").select("id", "rep"), "members")
        self.signed = written(signed.join(reps.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "sig"), "representatives")
        #: band, id, n: the places where representatives meet.
        self.meetings = self._meetings()

    def _meetings(self) -> DataFrame:
        width = 2 * self.rows
        bands = self.signed.where("n > 0").select("id", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda b: F.substring("sig", b * width + 1, F.lit(width)))).alias("band", "slice"))
        bands = bands.select("id", "n", F.xxhash64("band", "slice").alias("band"))
        # Most bands have one record: they go in the sort that the join needs anyway, before any pairing.
        near = Window.partitionBy("band").orderBy("id")
        shared = bands.withColumns({"before": F.lag("id").over(near), "after": F.lead("id").over(near)}).where("before IS NOT NULL OR after IS NOT NULL").select("band", "id", "n")
        return written(shared, "bands")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """(a, b, likeness) of the candidates (a, b, na, nb) that are over the threshold."""
        least = F.lit(self.threshold)
        pairs = pairs.where(F.least("na", "nb") >= least * F.greatest("na", "nb")).select("a", "b").distinct()
        # A signature of 192 places is off by 0.035: pairs more than five times that below the threshold aren't verified.
        places = self.bands * self.rows
        slack = 5 * (self.threshold * (1 - self.threshold) / places) ** 0.5
        sig_a, sig_b = self.signed.select(F.col("id").alias("a"), F.col("sig").alias("sa")), self.signed.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
        close = pairs.join(sig_a, "a").join(sig_b, "b").where(_agree(places)("sa", "sb") >= self.threshold - slack).select("a", "b")
        close = written(close, "candidates")
        ids = close.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        grams = written(self.texts.join(ids, "id", "left_semi").mapInArrow(_grams(self.shingle), "id long, grams array<long>"), "grams")
        ga, gb = grams.select(F.col("id").alias("a"), F.col("grams").alias("ga")), grams.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
        checked = close.join(ga, "a").join(gb, "b").select("a", "b", likeness("ga", "gb").alias("likeness")).where(F.col("likeness") >= least)
        return written(checked, "links")

    @cached_property
    def links(self) -> DataFrame:
        """(a, b, likeness), a < b: all verified pairs of representatives."""
        m = self.meetings
        a, b = m.select("band", F.col("id").alias("a"), F.col("n").alias("na")), m.select("band", F.col("id").alias("b"), F.col("n").alias("nb"))
        return self._verified(a.join(b, "band").where(F.col("a") < F.col("b")))

    @cached_property
    def classes(self) -> DataFrame:
        """(node, root) of the representatives that are linked to others, without pairing all members of a band.

        First every member of a band is compared with the band's smallest id and what is linked is joined. Then
        only members of one band that are still in different classes are compared, so a band that a third of
        all rows share costs comparisons in proportion to its rows, and no link between classes is lost.
        """
        m = self.meetings
        hubs = m.groupBy("band").agg(F.min(F.struct("id", "n")).alias("hub")).select("band", F.col("hub.id").alias("a"), F.col("hub.n").alias("na"))
        stars = self._verified(m.select("band", F.col("id").alias("b"), F.col("n").alias("nb")).join(hubs, "band").where(F.col("a") < F.col("b")))
        roots = written(connected_components(stars.select("a", "b")), "classes")
        known = m.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("band", "id", "n", F.coalesce("root", "id").alias("class"))
        known = written(known, "known")
        kinds = known.select("band", "class").distinct()
        apart = kinds.select("band", F.col("class").alias("ca")).join(kinds.select("band", F.col("class").alias("cb")), "band").where("ca < cb")
        one = known.select("band", F.col("class").alias("ca"), F.col("id").alias("x"), F.col("n").alias("nx"))
        two = known.select("band", F.col("class").alias("cb"), F.col("id").alias("y"), F.col("n").alias("ny"))
        met = apart.join(one, ["band", "ca"]).join(two, ["band", "cb"])
        ordered = F.when(F.col("x") < F.col("y"), F.struct(F.col("x").alias("a"), F.col("y").alias("b"), F.col("nx").alias("na"), F.col("ny").alias("nb"))).otherwise(F.struct(F.col("y").alias("a"), F.col("x").alias("b"), F.col("ny").alias("na"), F.col("nx").alias("nb")))
        more = self._verified(met.select(ordered.alias("p")).select("p.*"))
        return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more.select("a", "b")))

    def pairs(self) -> DataFrame:
        """(a, b, likeness), a < b: all pairs of rows, copies expanded."""
        m = self.members
        one, two = m.select(F.col("rep").alias("a"), F.col("id").alias("ia")), m.select(F.col("rep").alias("b"), F.col("id").alias("ib"))
        across = self.links.join(one, "a").join(two, "b").select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "likeness")
        copies = one.join(two, F.col("a") == F.col("b")).where("ia < ib").select(F.col("ia").alias("a"), F.col("ib").alias("b"), F.lit(1.0).alias("likeness"))
        return across.union(copies)

    def groups(self) -> DataFrame:
        """(id, class_id) for every row: the smallest id it is linked to through any chain."""
        return self.members.join(self.classes.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("root", "rep").alias("class_id"))
