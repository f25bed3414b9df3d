"""Hashes of substrings and words of an Arrow batch of texts, with numpy.

P[i] is the sum of T[b_j] * R**j over the bytes before i, modulo 2**64, with T a
table of random odd numbers and R odd. The hash of bytes a to b is
(P[b] - P[a]) * R**-a, mixed; it depends on those bytes alone, so any substring
costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 21
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)

ALNUM = np.zeros(256, bool)  # digits, letters and all bytes outside ASCII
ALNUM[np.r_[48:58, 65:91, 97:123, 128:256]] = True
SOLID = np.ones(256, bool)  # all but ASCII white space
SOLID[np.r_[9:14, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _table(lower: bool) -> np.ndarray:
    table = numbers(256, 7) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    return table


def pieces(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs (first, last + 1) of texts of at most `most` bytes together, or one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


class Hasher:
    def __init__(self, lower: bool):
        self.table = _table(lower)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) <= n:
            self.power = np.cumprod(np.append(np.uint64(1), np.full(n, _R, np.uint64)), dtype=np.uint64)
            self.inverse = np.cumprod(np.append(np.uint64(1), np.full(n, _R_INVERSE, np.uint64)), dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._reach(len(data))
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.table[data] * self.power[:len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * self.inverse[begin])


def word_places(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of all words, and for each text the number of words before it (one more at the end)."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = inside[data]
    change = solid[1:] != solid[:-1]
    # a text that begins inside a run of word bytes ends the word before it and begins its own
    joint = offsets[(offsets > 0) & (offsets < len(data))]
    joint = joint[solid[joint] & solid[joint + 1]]
    begin = change & solid[1:]
    end = change & solid[:-1]
    begin[joint] = end[joint] = True
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end), np.searchsorted(begins, offsets)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and for each text the number of words before it (one more at the end)."""
    begins, ends, upto = word_places(data, offsets, inside)
    sums = hasher.prefix(data)
    return hasher.between(sums, begins, ends), upto


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, in order."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * np.uint64(_R) + hashes[i:i + count]
    return mix(total)
