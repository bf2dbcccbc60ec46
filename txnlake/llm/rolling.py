"""Polynomial hashes of byte ranges, all at once with numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0x2545F4914F6CDD1D)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(max(n + 1, 1 << 18), base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


class Rolling:
    """Hashes of ranges of one byte string; equal bytes hash alike wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = _grown(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scramble((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return scramble((self.sums[length:] - self.sums[:n]) * self.down[:n])
