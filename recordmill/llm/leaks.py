"""Evaluation texts in training text: a positional inverted index, searched from the rarest terms.

The corpus is indexed by parts: each part holds, for every term of the evaluation items, the sorted list of its
places in the part's texts. Items are cut into blocks of half the words that make a leak, so any leak holds a
whole block. Blocks that don't occur in a part are put aside together, by one look-up of the part's windows
among all blocks, so a part's work follows its words and matches and not the number of items. The phrase of a
block that is left is found by taking the places of its rarest term, shifted to where the block would begin,
and intersecting them with the equally shifted lists of the next rarer terms until all agree; the places left
are extended to the longest runs of consecutive equal words. With a ``slop``, windows of an item whose terms
all occur, in any order, among so many more words are proximity matches.

Every document is read once. Items of up to ``ITEM_BYTES`` in all are sent to the parts, and no document is
shuffled. Larger sets of items stay distributed: (term, document) postings are joined with each block's
corpus-wide rarest term, and a document is searched for the items that share such a term with it.

Cases: null texts hold nothing; items of fewer words than ``min_words`` leak nowhere; very long texts and items
are taken whole; an item met twice in a document is one row of ``leaks`` and two spans; repeated rows are found
alike; no documents or items give no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from .words import WORD, WordHashes, hashed_words, mix, slices

#: Bytes of item texts that are sent to the executors; beyond it items are joined.
ITEM_BYTES = 32 << 20
#: Characters of a part of the index.
PART_CHARS = 16_000_000
SPANS = "doc long, item long, kind string, doc_word long, item_word long, words long"


class Items:
    """Numbered terms of the items and the hashes of their blocks."""

    def __init__(self, items: list[tuple[int, str]], min_words: int) -> None:
        self.number: dict[str, int] = {}
        number, self.min_words, self.block = self.number, min_words, (min_words + 1) // 2
        rows = [(i, np.fromiter((number.setdefault(w, len(number)) for w in WORD.findall(t.lower())), np.int32)) for i, t in items]
        self.rows = [(i, terms) for i, terms in rows if len(terms) >= min_words]
        self.begins = [np.arange(0, len(terms) - self.block + 1, self.block) for _, terms in self.rows]
        self.owner = np.repeat(np.arange(len(self.rows)), [len(b) for b in self.begins])
        self.offset = np.concatenate([*self.begins, np.empty(0, np.int64)]).astype(np.int64)
        hashes = [window_hashes(terms, self.block)[b] for (_, terms), b in zip(self.rows, self.begins, strict=True)]
        self.order = np.argsort(flat := np.concatenate([*hashes, np.empty(0, np.uint64)]), kind="stable")
        self.hashes = flat[self.order]


def window_hashes(terms: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(terms) - size + 1)
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + terms[k : k + n].astype(np.uint64) + np.uint64(1)
    return mix(acc)


class Postings:
    """Places of each term in one part of the corpus; a place that no term has divides the texts."""

    def __init__(self, texts: list[str | None], items: Items) -> None:
        found = [WORD.findall(t.lower()) if t else [] for t in texts]
        counts = np.fromiter((len(ws) + 1 for ws in found), np.int64, len(found))
        self.starts = np.cumsum(counts) - counts
        self.ends = self.starts + counts - 1
        get = items.number.get
        flat = np.full(int(counts.sum()), -1, np.int32)
        inside = np.ones(len(flat), bool)
        inside[self.ends] = False
        flat[inside] = np.fromiter((get(w, -1) for ws in found for w in ws), np.int32)
        self.flat, self.items = flat, items
        self.order = np.argsort(flat, kind="stable")
        self.bounds = np.searchsorted(flat[self.order], np.arange(len(items.number) + 1))

    def df(self, terms: np.ndarray) -> np.ndarray:
        return self.bounds[terms + 1] - self.bounds[terms]

    def places(self, term: int) -> np.ndarray:
        return self.order[self.bounds[term] : self.bounds[term + 1]]

    def blocks(self) -> np.ndarray:
        """Numbers of the items' blocks that occur in the part."""
        held, size = self.items.hashes, self.items.block
        if not len(held):
            return np.empty(0, np.int64)
        foreign = np.cumsum(np.concatenate([[0], self.flat < 0]))
        n = max(0, len(self.flat) - size + 1)
        whole = np.flatnonzero(foreign[size : size + n] == foreign[:n])
        # Windows of item terms only, looked up in the sorted blocks.
        windows = np.unique(window_hashes(self.flat, size)[whole])
        lo, hi = np.searchsorted(held, windows), np.searchsorted(held, windows, side="right")
        lo, width = lo[hi > lo], (hi - lo)[hi > lo]
        return np.sort(self.items.order[np.repeat(lo, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)])

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Places where the terms stand in a row."""
        df = self.df(terms)
        by_rarity = np.argsort(df, kind="stable").tolist()
        begins = self.places(terms[by_rarity[0]]) - by_rarity[0]
        for k in by_rarity[1:]:
            if not len(begins):
                break
            others = self.places(terms[k])
            at = np.searchsorted(others, begins + k)
            begins = begins[others[np.minimum(at, len(others) - 1)] == begins + k] if len(others) else begins[:0]
        return begins

    def near(self, terms: np.ndarray, slop: int) -> list[int]:
        """Places of the rarest term that have all terms within the phrase's length and ``slop`` words, in one text."""
        terms = np.unique(terms)
        reach = self.items.min_words + slop
        by_rarity = np.argsort(self.df(terms), kind="stable").tolist()
        at = self.places(terms[by_rarity[0]])
        for k in by_rarity[1:]:
            if not len(at):
                break
            others = self.places(terms[k])
            at = at[np.searchsorted(others, at + reach) > np.searchsorted(others, at - reach, side="right")]
        return [p for p in at.tolist() if self._together(p, terms, reach)]

    def _together(self, place: int, terms: np.ndarray, reach: int) -> bool:
        text = int(np.searchsorted(self.starts, place, side="right")) - 1
        lo, hi = max(int(self.starts[text]), place - reach + 1), min(int(self.ends[text]), place + reach)
        around = self.flat[lo:hi]
        return any(np.isin(terms, around[k : k + reach]).all() for k in range(max(1, hi - lo - reach + 1)))

    def extended(self, begin: int, terms: np.ndarray, s: int, e: int) -> tuple[int, int]:
        """The longest run [s, e) of the item's words that stand at ``begin`` + s ... in the part."""
        flat, n = self.flat, len(terms)
        while s > 0 and begin + s > 0 and flat[begin + s - 1] == terms[s - 1]:
            s -= 1
        while e < n and begin + e < len(flat) and flat[begin + e] == terms[e]:
            e += 1
        return s, e

    def spans(self, slop: int | None) -> list[tuple[int, str, int, int, int]]:
        """(item, kind, place, item offset, words) of all items' matches: maximal phrases, or proximity if there is a slop."""
        items, out = self.items, []
        if slop is not None:
            n = items.min_words
            for item, terms in items.rows:
                rare = np.lib.stride_tricks.sliding_window_view(self.df(terms), n).min(axis=1)
                starts = [*range(0, len(terms) - n, items.block), len(terms) - n]
                out += [(item, "proximity", place, k, n) for k in starts if rare[k] for place in self.near(terms[k : k + n], slop)]
            return out
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for b in self.blocks().tolist():
            own, k = int(items.owner[b]), int(items.offset[b])
            item, terms = items.rows[own]
            for begin in (self.phrase(terms[k : k + items.block]) - k).tolist():
                runs = found.setdefault((own, begin), [])
                if any(s <= k < e for s, e in runs):
                    continue
                s, e = self.extended(begin, terms, k, k + items.block)
                runs.append((s, e))
                if e - s >= items.min_words:
                    out.append((item, "phrase", begin + s, s, e - s))
        return out


def _searched(ids: np.ndarray, texts: list[str | None], items: Items, slop: int | None) -> pa.RecordBatch:
    index = Postings(texts, items)
    rows = index.spans(slop)
    item, kind, place, offset, words = zip(*rows, strict=True) if rows else ((),) * 5
    place = np.array(place, np.int64)
    doc = np.searchsorted(index.starts, place, side="right") - 1
    arrays = [pa.array(ids[doc]), pa.array(item, pa.int64()), pa.array(kind, pa.string()), pa.array(place - index.starts[doc]), pa.array(offset, pa.int64()), pa.array(words, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SPANS.split(", ")])


def _search(sent, min_words: int, slop: int | None):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, min_words)
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for lo, hi in slices(texts, most_rows=100_000, most_chars=PART_CHARS):
                yield _searched(ids[lo:hi], texts[lo:hi], items, slop)

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (term, doc), once for each of a document's terms."""
    hashes = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
        for lo, hi in slices(texts):
            flat, offsets = hashed_words(texts[lo:hi], hashes)
            own = np.repeat(np.arange(lo, hi), np.diff(offsets))
            order = np.lexsort((flat, own))
            own, flat = own[order], flat[order]
            first = np.ones(len(own), bool)
            first[1:] = (own[1:] != own[:-1]) | (flat[1:] != flat[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(flat[first].view(np.int64)), pa.array(ids[own[first]])], names=["term", "doc"])


def _windows(min_words: int, size: int):  # noqa: ANN202
    """(item, text) to (item, window, term) of the windows of ``size`` words."""
    step = (min_words + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, text in enumerate(texts):
                flat = hashed_words([text], hashes)[0].view(np.int64)
                if len(flat) >= min_words:
                    starts = np.unique(np.append(np.arange(0, len(flat) - size + 1, step), [] if size == step else [len(flat) - size])).astype(np.int64)
                    terms = np.concatenate([flat[s : s + size] for s in starts])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), ids[k], np.int64)), pa.array(np.repeat(starts, size)), pa.array(terms)], names=["item", "window", "term"])

    return run


def _routed(docs: DataFrame, wanted: DataFrame, min_words: int, slop: int | None) -> DataFrame:
    """The same spans by joins: documents meet the items whose windows' rarest terms they hold."""
    postings = docs.mapInArrow(_terms, "term long, doc long")
    size = (min_words + 1) // 2 if slop is None else min_words
    windows = written(wanted.mapInArrow(_windows(min_words, size), "item long, window long, term long").distinct(), "item-windows")
    frequency = postings.join(windows.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("docs"))
    # A window with a term that no document holds occurs nowhere.
    rarest = windows.join(frequency, "term", "left").groupBy("item", "window").agg(F.min_by("term", F.struct("docs", "term")).alias("term"), F.count_if(F.col("docs").isNull()).alias("missing"))
    anchors = written(rarest.where("missing = 0").select("term", "item").distinct(), "anchors")
    met = postings.join(anchors, "term").select("doc", "item").distinct()
    rows = met.join(wanted, "item").select("doc", F.lit(1).alias("kind"), "item", "text")
    held = docs.join(met.select("doc").distinct(), "doc", "left_semi").select("doc", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("item"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, some, chars = None, [], [], 0

        def searched() -> pa.RecordBatch:
            return _searched(np.full(len(texts), now, np.int64), texts, Items(some, min_words), slop)

        for batch in batches:
            for doc, kind, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc != now or chars > PART_CHARS) and some:  # very many items are searched in parts
                    yield searched()
                    some, chars = [], 0
                if doc != now:
                    now, texts = doc, []
                if kind:
                    some.append((item, text))
                    chars += len(text)
                else:
                    texts.append(text)
        if some:
            yield searched()

    return rows.union(held).repartition("doc").sortWithinPartitions("doc", "kind").mapInArrow(run, SPANS)


def spans(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", min_words: int = 12, slop: int | None = None) -> DataFrame:
    """(doc, item, kind, doc_word, item_word, words): maximal phrase matches, or proximity matches if there is a slop."""
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("text IS NOT NULL AND doc IS NOT NULL")
    wanted = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL AND item IS NOT NULL").distinct()
    size = wanted.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    if size > ITEM_BYTES:
        return _routed(docs, wanted, min_words, slop)
    sent = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in wanted.collect()])  # at most ITEM_BYTES, checked above
    return spread(docs).mapInArrow(_search(sent, min_words, slop), SPANS)


def leaks(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", min_words: int = 12, slop: int | None = None) -> DataFrame:
    """(doc_id, item_id, spans, words) once for each document and item: matches and words in the longest."""
    found = spans(documents, items, doc_id, item_id, text, min_words, slop)
    return found.groupBy(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).agg(F.count("*").alias("spans"), F.max("words").alias("words"))
