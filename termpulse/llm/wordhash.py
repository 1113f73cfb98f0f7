"""Hashes of words and of runs of words as arrays."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

#: Multiplier of the rolling sums, odd, so that it has an inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), dtype=np.uint64, count=len(words))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of sums, so that their order is as good as random."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Hashes of any runs of one document's words, from running sums modulo 2 ** 64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(INVERSE, n), out=self.sums[1:])
        self.up = powers(BASE, n + 1)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.up[starts])

    def windows(self, width: int) -> np.ndarray:
        """Of every run of ``width`` words, by its start."""
        n = len(self.sums) - 1 - width + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * self.up[:n])
