"""Words, word hashes and three-word sequences of texts, for whole Arrow batches at a time.

A word is a longest run of letters and digits of the lower-cased text; an underscore ends a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
#: The same words as a Java pattern, for ``regexp_extract_all(lower(text), ...)``.
JAVA_WORD = r"[\p{L}\p{N}]+"

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xC2B2AE3D27D4EB4F)
_K3 = np.uint64(0x165667B19E3779F9)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def slices(texts: list[str | None], most_rows: int = 2_000, most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most_chars`` characters, or of one longer text, so that memory is bounded."""
    lo = chars = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > lo and (chars + n > most_chars or k - lo >= most_rows):
            yield lo, k
            lo, chars = k, 0
        chars += n
    if lo < len(texts):
        yield lo, len(texts)


class WordHashes(dict):
    """word -> 64-bit hash; forgets everything when it grows large, so memory is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def hashed_words(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and the offsets of the texts in it."""
    found = [WORD.findall(t.lower()) for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    offsets = np.zeros(len(found) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    get = hashes.__getitem__
    flat = np.fromiter((get(w) for ws in found for w in ws), np.uint64, int(offsets[-1]))
    return flat, offsets


def gram_hashes(flat: np.ndarray, offsets: np.ndarray, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every distinct sequence of ``size`` words of each text, sorted by text number and hash."""
    n = len(flat) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    factor = int(_K1)
    for i in range(size):
        acc = mix(acc * _K2 + flat[i : i + n] * np.uint64(factor) + _K3)
        factor = factor * int(_K3) % (1 << 64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = owner[:n] == owner[size - 1 : size - 1 + n]
    doc, h = owner[:n][inside], acc[inside]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]


def content_keys(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A 128-bit key of each text's word sequence: equal for texts that differ in case, blanks or punctuation only."""
    raw = memoryview(np.ascontiguousarray(flat)).cast("B")
    return [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
