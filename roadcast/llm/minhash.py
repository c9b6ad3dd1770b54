"""Signatures of word shingles by circulant MinHash.

Two permutations make all coordinates of a signature. The first spreads a shingle over
the universe, here the 32-bit numbers: it is the shingle's hash. The second is a fixed
bijection of the universe; coordinate k is the least value it takes over a document's
set after the set was shifted by k places around the universe.
"""

from __future__ import annotations

import math

import numpy as np

from roadcast.llm.wordhash import mix64

_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_NONE = mix64(np.arange(101, 165, dtype=np.uint64))


def bands_for(similarity: float, rows: int, missed: float = 1e-5) -> int:
    """Bands of ``rows`` coordinates after which a pair of that similarity shares none
    with a probability of at most ``missed``."""
    return math.ceil(math.log(missed) / math.log(1 - similarity**rows))


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, given its words' hashes; a text of
    fewer words has the whole sequence as its only one, one without words none."""
    ends = np.cumsum(counts)
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for j in range(size):
        total += hashes[j : j + len(total)] * _ODD[j]
    total = mix64(total)
    sets = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= size:
            sets.append(np.unique(total[end - n : end - size + 1]))
        elif n:
            whole = hashes[end - n : end] * _ODD[:n]
            sets.append(mix64(whole.sum(keepdims=True) + _NONE[n]))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _bijection(x: np.ndarray) -> np.ndarray:
    """The second permutation, in place: each step can be undone."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """A row of ``length`` coordinates for each of the sets, none of which is empty."""
    out = np.empty((len(sets), length), np.uint32)
    first = 0
    while first < len(sets):
        # Some ten thousand shingles at a time stay in the processor's cache.
        last, n = first, 0
        while last < len(sets) and (last == first or n + len(sets[last]) <= 16384):
            n += len(sets[last])
            last += 1
        spread = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        for k in range(length):
            out[first:last, k] = np.minimum.reduceat(_bijection(spread + np.uint32(k)), starts)
        first = last
    return out


def band_keys(signs: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band of ``rows`` coordinates, telling the bands apart."""
    n, length = signs.shape
    bands = signs.reshape(n, length // rows, rows).astype(np.uint64)
    key = np.broadcast_to(_NONE[: length // rows], (n, length // rows)).copy()
    for j in range(rows):
        key = mix64(key + bands[:, :, j] * _ODD[j])
    return key.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)
