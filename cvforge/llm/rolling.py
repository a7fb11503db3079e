"""Prefix polynomial hashes over byte arrays: the hash of any span in constant time.

Arithmetic is modulo 2**64; each byte value stands for a random odd 64-bit number and the
base is odd, so it has an inverse and a span's hash does not depend on where it stands.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (two rounds of multiply and fold)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Base:
    """A base with the powers of it and of its inverse, grown as needed."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.values = draw.integers(0, 1 << 64, 256, np.uint64, endpoint=False) | U(1)
        self.base = int(draw.integers(0, 1 << 64, dtype=np.uint64)) | 5
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) <= n:
            inverse = pow(self.base, -1, 1 << 64)
            for name, x in (("powers", self.base), ("inverses", inverse)):
                steps = np.full(n + 1, x % (1 << 64), np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums for ``span`` over a byte array."""
        self.grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def span(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, stop)."""
        return (sums[stop] - sums[start]) * self.inverses[start]
