"""A full-text index of word sequences: Burrows-Wheeler transform, occurrence lists, sampled suffix array.

Searches run for many query places at once, word by word from right to left; the indexed words
themselves aren't kept.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of an integer sequence, by doubling of the sorted prefixes."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, width = len(text), 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1
        order_key = rank * (n + 2) + follow
        order = np.argsort(order_key, kind="stable")
        ordered = order_key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        if rank[order[-1]] == n - 1 or width >= n:
            return order
        width *= 2


class FMIndex:
    """Index of several texts, given as word hashes in one array with offsets."""

    SAMPLE = 8

    def __init__(self, flat: np.ndarray, offsets: np.ndarray) -> None:
        counts = np.diff(offsets)
        self.starts = offsets[:-1] + np.arange(len(counts))  # one dividing word after each text
        self.alphabet = np.unique(flat)
        # 1 divides texts; the one 0 at the end makes stepping back well defined.
        text = np.ones(len(flat) + len(counts) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[self.starts + counts] = False
        text[-1], inside[-1] = 0, False
        text[inside] = np.searchsorted(self.alphabet, flat) + 2
        n = self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]
        #: (word, place in the transform), sorted: the number of entries before (c, i) is the next place of a search.
        self.keys = np.sort(bwt * (n + 1) + np.arange(n))
        sampled = order % self.SAMPLE == 0
        self.sampled = sampled
        self.rank = np.cumsum(sampled) - sampled
        self.samples = order[sampled].astype(np.int32)
        self.bwt = bwt.astype(np.int32)

    def encoded(self, flat: np.ndarray) -> np.ndarray:
        """Word hashes as words of this index; 0 for others."""
        if not len(self.alphabet):
            return np.zeros(len(flat), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == flat, at + 2, 0)

    def search(self, words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query place, lo, hi) of the runs of ``length`` words of the queries that the index holds; each begins at its place."""
        ends = np.arange(len(words))
        begin = np.repeat(offsets[:-1], np.diff(offsets))
        ends = ends[(ends - begin >= length - 1) & (words > 0)]
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        for back in range(length):
            c = words[ends - back] * (self.n + 1)
            lo, hi = np.searchsorted(self.keys, c + lo), np.searchsorted(self.keys, c + hi)
            alive = (lo < hi) & (c > 0)
            ends, lo, hi = ends[alive], lo[alive], hi[alive]
            if not len(ends):
                break
        return ends - (length - 1), lo, hi

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text places of places in the transform, by stepping back to a sampled one."""
        at, steps = places.copy(), np.zeros(len(places), np.int64)
        open_ = np.flatnonzero(~self.sampled[at])
        while len(open_):
            i = at[open_]
            at[open_] = np.searchsorted(self.keys, self.bwt[i].astype(np.int64) * (self.n + 1) + i)
            steps[open_] += 1
            open_ = open_[~self.sampled[at[open_]]]
        return self.samples[self.rank[at]] + steps

    def matches(self, flat: np.ndarray, offsets: np.ndarray, length: int, block: int = 1 << 20) -> tuple[np.ndarray, ...]:
        """(query text, indexed text, query word, indexed word, words) of all maximal matches of at least ``length`` words."""
        place, lo, hi = self.search(self.encoded(flat), offsets, length)
        width = hi - lo
        found = []
        for a in _blocks(width, block):
            w = width[a]
            q = np.repeat(place[a], w)
            t = self.locate(np.repeat(lo[a], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w))
            found.append((q, t))
        if not found:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty, empty
        q, t = (np.concatenate(x) for x in zip(*found, strict=True))
        # Runs that follow each other on one diagonal are one longer match.
        query_text = np.searchsorted(offsets, q, side="right") - 1
        text = np.searchsorted(self.starts, t, side="right") - 1
        order = np.lexsort((q, t - q, text, query_text))
        q, t, query_text, text = q[order], t[order], query_text[order], text[order]
        fresh = np.ones(len(q), bool)
        fresh[1:] = (q[1:] != q[:-1] + 1) | (t[1:] != t[:-1] + 1) | (query_text[1:] != query_text[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(fresh)
        runs = np.diff(np.append(first, len(q))) + length - 1
        return query_text[first], text[first], q[first] - offsets[query_text[first]], t[first] - self.starts[text[first]], runs


def _blocks(width: np.ndarray, block: int):  # noqa: ANN202
    """Slices of rows whose widths sum to about ``block``."""
    ends = np.cumsum(width)
    a = 0
    while a < len(width):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + block, side="right")))
        yield slice(a, b)
        a = b
