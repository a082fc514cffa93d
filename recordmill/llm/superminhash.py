"""SuperMinHash signatures of many sets at once.

Each element walks a random permutation of the signature's places, one step a level; at level j it
offers a value in [j, j + 1) to the place it reaches. All values of a level exceed all of the level
before, so a set is finished as soon as its largest value lies below the next level: large sets stop
after one or two levels. The shared ranks make the estimate's variance smaller than that of
independent minima.
"""

from __future__ import annotations

import numpy as np

from .words import mix

_G = 0x9E3779B97F4A7C15
_G2 = np.uint64(0xD1B54A32D192ED03)
_SHIFT = np.uint64(11)
_UNIT = 1.0 / (1 << 53)


def signatures(owner: np.ndarray, hashes: np.ndarray, sets: int, places: int, block: int = 40_000) -> np.ndarray:
    """(sets, places) float64; ``owner`` is sorted. Sets without elements get infinities.

    Blocks bound the memory of the permutations to about ``2 * block * places`` bytes; a larger set is
    taken in parts, whose least values are those of the whole.
    """
    out = np.full((sets, places), np.inf)
    starts = np.searchsorted(owner, np.arange(sets + 1))
    a = 0
    while a < sets:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + block, side="right")) - 1)
        b = min(b, sets)
        for k in range(starts[a], starts[b], block):
            end = min(k + block, starts[b])
            _block(owner[k:end] - a, hashes[k:end], out[a:b])
        a = b
    return out


def _block(owner: np.ndarray, hashes: np.ndarray, out: np.ndarray) -> None:
    places = out.shape[1]
    flat = out.reshape(-1)
    perm = np.broadcast_to(np.arange(places, dtype=np.uint16), (len(hashes), places)).copy() if len(hashes) else None
    own, el = owner, np.arange(len(hashes))
    for level in range(places):
        if not len(el):
            return
        seed = mix(hashes[el] + np.uint64((level + 1) * _G % (1 << 64)))
        rank = (seed >> _SHIFT).astype(np.float64) * _UNIT
        k = level + (mix(seed + _G2) % np.uint64(places - level)).astype(np.int64)
        place = perm[el, k]
        perm[el, k] = perm[el, level]
        perm[el, level] = place
        np.minimum.at(flat, own * places + place, level + rank)
        unfinished = out.max(axis=1) >= level + 1
        keep = unfinished[own]
        if not keep.all():
            el, own = el[keep], own[keep]


def packed(sig: np.ndarray) -> np.ndarray:
    """Signatures as 16 bits a place: equal values stay equal, different ones collide once in 65,536."""
    bits = mix(sig.view(np.uint64))
    return (bits >> np.uint64(48)).astype(np.uint16)
