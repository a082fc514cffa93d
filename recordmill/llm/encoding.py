"""Encoding of a corpus with a byte-level BPE vocabulary, by a pair occurrence index.

All distinct pre-tokens that a partition hasn't met yet are laid out in one array. An index maps each
pair's merge rank to all its positions; active ranks are taken in ascending order, each is applied at
all its positions, and the lists of the pairs that come and go are updated. A pre-token is so encoded
once a partition, however often it occurs, and one of a megabyte costs n log n.

Cases: null and empty texts give an empty list; strings of special tokens in a text are ordinary text;
very long texts are taken whole; repeated rows are encoded alike; no rows give no rows; other columns
aren't read.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .words import slices

#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary goes to every executor, so its size is checked.
VOCABULARY_BYTES = 32 << 20
#: Distinct pre-tokens kept at most; beyond, the memory of them begins anew.
KEPT = 400_000


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """token bytes -> id of a vocabulary file with one base64 token and its id a line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class PairIndex:
    """Encodes batches of distinct pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}

    def rank_of(self, left: int, right: int) -> int:
        """The id that a pair merges into; -1 if none."""
        pair = (left, right)
        found = self.merged.get(pair)
        if found is None:
            if len(self.merged) > 2_000_000:
                self.merged.clear()
            found = self.merged[pair] = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
        return found

    def encode(self, tokens: list[bytes]) -> list[list[int]]:
        single, rank_of = self.single, self.rank_of
        symbols = [single[b] for token in tokens for b in token]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        start, k = [], 0
        for token in tokens:
            start.append(k)
            k += len(token)
            if token:
                before[k - len(token)], after[k - 1] = -1, -1
        positions: dict[int, list[int]] = {}
        for i in range(n):
            if after[i] >= 0 and (rank := rank_of(symbols[i], symbols[i + 1])) >= 0:
                positions.setdefault(rank, []).append(i)
        active = list(positions)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            for i in sorted(positions.pop(rank)):
                j = after[i]
                # The pair may be gone: one of its symbols was merged with another neighbour.
                if symbols[i] < 0 or j < 0 or rank_of(symbols[i], symbols[j]) != rank:
                    continue
                symbols[i], symbols[j] = rank, -1
                after[i] = k = after[j]
                if k >= 0:
                    before[k] = i
                    if (new := rank_of(rank, symbols[k])) >= 0:
                        if new not in positions:
                            positions[new] = []
                            heapq.heappush(active, new)
                        positions[new].append(i)
                h = before[i]
                if h >= 0 and (new := rank_of(symbols[h], rank)) >= 0:
                    if new not in positions:
                        positions[new] = []
                        heapq.heappush(active, new)
                    positions[new].append(h)
        out = []
        for token, i in zip(tokens, start, strict=True):
            ids = []
            while token and i >= 0:
                ids.append(symbols[i])
                i = after[i]
            out.append(ids)
        return out


class Encoder:
    """Texts to ids; remembers the ids of the pre-tokens met."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import regex

        self.find = regex.compile(PATTERN).findall
        self.index = PairIndex(ranks)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts, self.starts, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the texts' offsets in it."""
        if len(self.number) > KEPT:
            self._forget()
        number = self.number
        found = [self.find(t) if t else [] for t in texts]
        known = len(number)
        rows = np.fromiter((number.setdefault(w, len(number)) for ws in found for w in ws), np.int64)
        if len(number) > known:
            new = [w.encode("utf-8", "replace") for w in list(number)[known:]]
            encoded = self.index.encode(new)
            self.starts = np.concatenate([self.starts, np.zeros(len(new), np.int64)])
            counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self.starts[known:] = len(self.ids) + np.cumsum(counts) - counts
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, np.fromiter((i for ids in encoded for i in ids), np.int32, int(counts.sum()))])
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[rows] - (ends - counts), counts) + np.arange(total)
        tokens = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)), out=tokens[1:])
        offsets = np.concatenate([[0], ends])[tokens]
        return self.ids[places], offsets


def encode(texts: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id_col, ids) for every row; ``vocabulary`` is the path of the vocabulary file on the driver."""
    if os.path.getsize(vocabulary) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to send to every executor")
    with open(vocabulary, "rb") as f:
        sent = texts.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(load_ranks(sent.value))
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts, 1_000, 2_000_000):
                ids, offsets = encoder(texts[lo:hi])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=[id_col, "ids"])

    rows = texts.select(F.col(id_col), F.col(text_col).cast("string"))
    return spread(rows).mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids array<int>")
