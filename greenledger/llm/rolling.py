"""Hashes of byte ranges by prefix sums: one pass over a text, then any range in O(1)."""

from __future__ import annotations

import numpy as np

#: An odd multiplier.
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of ``BASE`` and of its inverse modulo 2**64, as far as asked for."""

    n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            self.up, self.down = (np.cumprod(np.concatenate(
                [[np.uint64(1)], np.full(self.n, b, np.uint64)]).astype(np.uint64)) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up, self.down


POWERS = Powers()


class Ranges:
    """Hashes of ranges of one byte string."""

    def __init__(self, data: np.ndarray):
        up, self.down = POWERS.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])
