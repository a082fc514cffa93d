"""Same or near-same records across splits: full-text indexes of evaluation shards, searched with training text.

Evaluation texts are spread over shards of about equal size and each shard is indexed. A training text is
streamed only through the shards that can hold a partner of it. Of a text with n distinct sequences of
``shingle`` words, a partner holds need = ceil(threshold * n) or more, as likeness is never over the shared
part of either text. So a text of which all evaluation texts together hold fewer than need is left out. All
sequences have one order, and the k-th of those that a pair shares has need - k or more shared ones behind it in
either text: the first n - need + k of both texts hold k shared ones or more, whatever the order is. Only these are
sent, with k a quarter of the training text's need, which is at most a quarter of the partner's sequences. The order
begins with the rare, so that sequences which very many texts hold route only what has little else; it comes from
a table of a fixed number of counters of all sequences of all evaluation texts, in which two that share a counter
only count as commoner, and a counter of zero is of sequences that no evaluation text holds. No pair over the
threshold is lost to this, whatever the texts are; nothing is sampled.

In a shard the same bound gives the pairs that can be over the threshold: those with one of a text's n - need + 1
rarest sequences in common. All of them are checked exactly. Backward search gives the maximal matches of the
pairs that are left; their spans are merged and counted, and tell nothing about which pairs are found.

Cases: null texts and texts under ``min_words`` words are in no pair; copies of one word sequence are
searched once and stand for each other; very long texts are taken whole; a record that is in both sides
(it shouldn't be) is paired with others, never itself; repeated rows are one, and of several texts of a record
one is taken; no rows give no rows; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .fm_index import FMIndex, _blocks
from .words import WordHashes, content_keys, gram_hashes, hashed_words, slices

#: Words that a match must have to be counted as a span.
MATCH_WORDS = 5
#: Characters of a shard's evaluation texts, training texts that pass one task of a shard, and evaluation texts from which sequences count as equally common (it orders them, and drops none).
SHARD_CHARS, TASK_TEXTS, COMMON = 2_000_000, 20_000, 100
#: Counters of sequences (one byte each when sent), and those in one row.
COUNTERS, SLICE = 1 << 24, 1 << 16
PAIRS = "train long, eval long, likeness double, matched_words long, longest_match long, spans long"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, columns ...) to (key, chars, columns ...)."""
    hashes = WordHashes()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for lo, hi in slices(texts):
            keys = content_keys(*hashed_words(texts[lo:hi], hashes))
            rest = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([len(t) for t in texts[lo:hi]], pa.int64()), *rest.columns[1:]], names=["key", "chars", *rest.schema.names[1:]])


def _need(n, threshold: float):  # noqa: ANN001, ANN202
    """Sequences of n that a partner holds at least; the rounding is taken off, so that of 5 at 0.6 it is 3 and not 4."""
    return np.ceil(n * threshold - 1e-6).astype(np.int64)


def _counters(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(COUNTERS - 1)).view(np.int64)


def _counted(shingle: int):  # noqa: ANN202
    """Texts to (slice, counts), the slices of the table of counters that aren't zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                at, n = np.unique(_counters(gram_hashes(*hashed_words(texts[lo:hi], hashes), shingle)[1]), return_counts=True)
                counts[at] += n.astype(np.uint32)
        for k, part in enumerate(counts.reshape(-1, SLICE)):
            if most := part.max():
                packed = zlib.compress(part.astype(np.min_scalar_type(most)).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([packed], pa.binary())], names=["slice", "counts"])

    return run


def _leveled(unit: int, most: int):  # noqa: ANN202
    """(slice, counts) of all parts, by slice, to (slice, levels): a byte for each counter, 0 for zero only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = zlib.decompress(packed)
                sums.setdefault(k, np.zeros(SLICE, np.uint32))[:] += np.frombuffer(raw, f"u{len(raw) // SLICE}")
        for k, part in sums.items():
            levels = np.minimum((part + np.uint32(unit - 1)) // np.uint32(unit), most).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([levels.tobytes()], pa.binary())], names=["slice", "levels"])

    return run


def _levels(held: DataFrame, chars: int, shingle: int) -> np.ndarray:
    """How common the sequences of each counter are among all evaluation texts, from 0 (held by none) to COMMON.

    The unit is about the sequences of a counter on average, so that the order stays telling when all are in use.
    """
    unit = max(1, chars // 8 // COUNTERS)
    parts = held.mapInArrow(_counted(shingle), "slice long, counts binary").repartition("slice")
    levels = np.zeros((COUNTERS // SLICE, SLICE), np.uint8)
    for row in parts.mapInArrow(_leveled(unit, min(COMMON, 255)), "slice long, levels binary").collect():  # at most COUNTERS bytes
        levels[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return levels.ravel()


def _first(own: np.ndarray, grams: np.ndarray, texts: int, levels: np.ndarray, threshold: float, train: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the sequences of each text that are sent, and how many of them a shard with a partner of it holds at least."""
    n = np.bincount(own, minlength=texts)
    need = _need(n, threshold)
    # An evaluation text doesn't know how much of it a partner needs, but that is no more than all.
    asked = -(-(need if train else n) // 4)
    level = levels[_counters(grams)]
    present = np.bincount(own[level > 0], minlength=texts)
    present = np.where(present >= need, present, 0)
    held = np.flatnonzero((level > 0) & (present > 0)[own])
    # Sequences of a text come in the order of their hashes, and stay in it where levels are equal.
    order = held[np.argsort(own[held] * 256 + level[held], kind="stable")]
    place = np.arange(len(order)) - np.repeat(np.cumsum(present) - present, present)
    return order[place < (present - need + asked)[own[order]]], asked


def _grams(shingle: int, threshold: float = 0.0, levels: Broadcast | None = None, train: bool = True):  # noqa: ANN202
    """(id, text) to (doc, n, gram), a row for each of the n distinct sequences of a text.

    With levels, to (doc, asked, gram), a row for each of the sequences that are sent. A sequence is sent as 40 bits
    of its hash: two that share them count as held by more texts, which may add candidates and loses none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                own, grams = gram_hashes(*hashed_words(texts[lo:hi], hashes), shingle)
                n = np.bincount(own, minlength=hi - lo)
                if levels is not None:
                    sent, n = _first(own, grams, hi - lo, levels.value, threshold, train)
                    own, grams = own[sent], grams[sent]
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][own]), pa.array(n[own], pa.int64()), pa.array((grams >> np.uint64(24)).view(np.int64))], names=["doc", "n" if levels is None else "asked", "gram"])

    return run


class Shard:
    """One indexed shard and the exact sets of its texts."""

    def __init__(self, ids: list[int], texts: list[str], hashes: WordHashes, shingle: int, threshold: float) -> None:
        self.ids, self.shingle, self.threshold, self.hashes = np.array(ids, np.int64), shingle, threshold, hashes
        flat, offsets = hashed_words(texts, hashes)
        self.words, self.offsets = flat, offsets
        own, self.grams = gram_hashes(flat, offsets, shingle)
        self.ends = np.searchsorted(own, np.arange(len(ids) + 1))
        order = np.argsort(self.grams, kind="stable")
        self.holders = own[order]
        self.held, self.first, self.count = np.unique(self.grams[order], return_index=True, return_counts=True)

    @cached_property
    def index(self) -> FMIndex:
        return FMIndex(self.words, self.offsets)

    def candidates(self, own: np.ndarray, grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Distinct (query text, indexed text) of all pairs that can be over the threshold."""
        n = np.diff(ends)
        if not len(self.held) or not len(grams):
            return np.empty((0, 2), np.int64)
        at = np.minimum(np.searchsorted(self.held, grams), len(self.held) - 1)
        texts = np.where(self.held[at] == grams, self.count[at], 0)
        order = np.lexsort((texts, own))
        rare = np.arange(len(own)) - ends[own] <= (n - _need(n, self.threshold))[own]
        chosen = order[rare & (texts[order] > 0)]
        found = [np.empty(0, np.int64)]
        for a in _blocks(texts[chosen], 1 << 22):
            part, w = chosen[a], texts[chosen[a]]
            places = np.repeat(self.first[at[part]], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            found.append(np.unique(np.repeat(own[part], w) * len(self.ids) + self.holders[places]))
        return np.stack(np.divmod(np.unique(np.concatenate(found)), len(self.ids)), axis=1)

    def spans(self, flat: np.ndarray, offsets: np.ndarray, texts: list[int]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(query text, indexed text) to (words in matches, longest match, matches) of the numbered query texts."""
        counts = np.diff(offsets)[texts]
        words = np.concatenate([flat[offsets[t] : offsets[t + 1]] for t in texts])
        train, held, at, _, run = self.index.matches(words, np.concatenate([[0], np.cumsum(counts)]), MATCH_WORDS)
        out = {}
        bounds = np.flatnonzero(np.concatenate([[True], (train[1:] != train[:-1]) | (held[1:] != held[:-1])])) if len(train) else []
        for a, b in zip(bounds, [*bounds[1:], len(train)], strict=True):
            order = np.argsort(at[a:b], kind="stable")
            s, stop = at[a:b][order], (at[a:b] + run[a:b])[order]
            reach = np.maximum.accumulate(stop)
            covered = int(np.maximum(0, stop - np.maximum(s, np.concatenate([[0], reach[:-1]]))).sum())
            out[texts[int(train[a])], int(held[a])] = covered, int(run[a:b].max()), int(b - a)
        return out

    def pairs(self, ids: np.ndarray, texts: list[str]) -> pa.RecordBatch:
        flat, offsets = hashed_words(texts, self.hashes)
        own, grams = gram_hashes(flat, offsets, self.shingle)
        ends = np.searchsorted(own, np.arange(len(texts) + 1))
        alike = {}
        for t, e in self.candidates(own, grams, ends).tolist():
            x, y = grams[ends[t] : ends[t + 1]], self.grams[self.ends[e] : self.ends[e + 1]]
            if min(len(x), len(y)) < _need(max(len(x), len(y)), self.threshold) or self.ids[e] == ids[t]:
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            likeness = both / (len(x) + len(y) - both)
            if likeness >= self.threshold:
                alike[t, e] = likeness
        spans = self.spans(flat, offsets, sorted({t for t, _ in alike})) if alike else {}
        rows = [(int(ids[t]), int(self.ids[e]), likeness, *spans.get((t, e), (0, 0, 0))) for (t, e), likeness in alike.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in PAIRS.split(", ")])


def _search(shingle: int, threshold: float):  # noqa: ANN202
    """Rows (shard, train, id, text), sorted: the evaluation texts of a shard come before its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        now, shard, held_ids, held_texts = None, None, [], []
        for batch in batches:
            keys, train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            k = 0
            while k < len(keys):
                if keys[k] != now:
                    now, shard, held_ids, held_texts = keys[k], None, [], []
                end = k
                chars = 0
                while end < len(keys) and chars < 1_000_000 and keys[end] == now and train[end] == train[k]:
                    chars += len(texts[end])
                    end += 1
                if not train[k]:
                    held_ids += ids[k:end]
                    held_texts += texts[k:end]
                elif held_ids:
                    shard = shard or Shard(held_ids, held_texts, hashes, shingle, threshold)
                    found = shard.pairs(np.array(ids[k:end], np.int64), texts[k:end])
                    if found.num_rows:
                        yield found
                k = end

    return run


def near_pairs(texts: DataFrame, threshold: float = 0.8, shingle: int = 5, sides: DataFrame | None = None) -> DataFrame:
    """PAIRS of the rows (id, train, text) that are alike, one in training, the other not.

    With rows (id, train) in ``sides``, the texts are rows (id, text), and meet their sides without being moved.
    """
    at = ["id"] if sides is not None else ["id", "train"]
    usable = texts.select("text", *at).where(" AND ".join(f"{c} IS NOT NULL" for c in ("text", *at))).withColumn("form", F.xxhash64("text"))
    keys = usable.mapInArrow(_keys, f"key binary, chars long, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in usable.schema[1:])}")
    if sides is not None:
        keys = keys.join(sides.select("id", "train").where("id IS NOT NULL AND train IS NOT NULL").distinct(), "id")
    keyed = written(keys.groupBy("id", "train").agg(F.min(F.struct("key", "form", "chars")).alias("r")).select("id", "train", "r.*"), "keys")
    # One text stands for its copies on each side; copies across the sides are pairs without a search.
    reps = written(keyed.groupBy("key", "train").agg(F.min(F.struct("id", "form", "chars")).alias("r")).select("key", "train", "r.*"), "reps")
    members = written(keyed.select("id", "train", "key").join(reps.select("key", "train", F.col("id").alias("rep")), ["key", "train"]).select("id", "train", "rep", "key"), "side-members")
    # Texts are shuffled and written here once; what follows reads them where they are.
    unique = written(usable.join(reps.select("id", "train", "form"), [*at, "form"]).dropDuplicates(["id", "form", "train"]).select("id", "train", "text"), "unique")
    held_chars = reps.where("NOT train").agg(F.sum("chars").alias("n")).first()["n"] or 0
    shards = max(1, -(-held_chars // SHARD_CHARS))
    shard_of = F.pmod(F.xxhash64("eval"), F.lit(shards)).cast("long")
    side = {train: unique.where(F.col("train") == train) for train in (True, False)}
    levels = texts.sparkSession.sparkContext.broadcast(_levels(side[False].select("text"), held_chars, shingle))
    sent = {train: rows.select("id", "text").mapInArrow(_grams(shingle, threshold, levels, train), "doc long, asked long, gram long") for train, rows in side.items()}
    places = sent[False].select("gram", F.col("doc").alias("eval")).select("gram", shard_of.alias("shard")).distinct()
    shared = sent[True].join(places, "gram").groupBy("doc", "shard").agg(F.count("*").alias("shared"), F.first("asked").alias("asked"))
    routes = written(shared.where("shared >= asked").select("doc", "shard"), "routes")
    loads = routes.groupBy("shard").agg((F.count("*") / TASK_TEXTS).cast("int").alias("more"))
    salt = F.pmod(F.xxhash64("doc"), F.col("more") + 1)
    train_rows = routes.join(loads, "shard").select("doc", F.col("shard") * 100_000 + salt, F.lit(True)).toDF("id", "task", "train")
    eval_rows = side[False].select(F.col("id").alias("eval")).withColumn("shard", shard_of).join(loads, "shard").select("eval", F.explode(F.transform(F.sequence(F.lit(0), F.col("more")), lambda s: F.col("shard") * 100_000 + s)), F.lit(False)).toDF("id", "task", "train")
    tasks = train_rows.union(eval_rows).join(unique, ["id", "train"])
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * shards)
    ordered = tasks.select("task", "train", "id", "text").repartition(parts, "task").sortWithinPartitions("task", "train", "id")
    found = written(ordered.mapInArrow(_search(shingle, threshold), PAIRS), "overlaps")
    t, e = members.where("train").select(F.col("rep").alias("train"), F.col("id").alias("t"), "key"), members.where("NOT train").select(F.col("rep").alias("eval"), F.col("id").alias("e"), "key")
    facts = ["likeness", "matched_words", "longest_match", "spans"]
    return found.join(t.drop("key"), "train").join(e.drop("key"), "eval").select(F.col("t").alias("train"), F.col("e").alias("eval"), *facts)


def same_keys(records: DataFrame, *keys: str) -> DataFrame:
    """(train, eval) of the rows (id, train, keys ...) that agree in all keys, none of which is null."""
    rows = records.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).select("id", "train", *keys).distinct()
    t, e = rows.where("train").select(F.col("id").alias("t"), *keys), rows.where("NOT train").select(F.col("id").alias("e"), *keys)
    return t.join(e, list(keys)).where("t <> e").select(F.col("t").alias("train"), F.col("e").alias("eval"))
