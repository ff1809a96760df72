"""Hashes of many substrings at once: polynomial prefix sums modulo 2**64, in numpy.

Equal strings have equal hashes; unequal ones differ except by chance, so callers that need
certainty compare the strings as well.
"""

from __future__ import annotations

import numpy as np

#: An odd factor, so that powers have inverses.
FACTOR = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of the 64 over all of them."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Powers and letter values; make one per task."""

    def __init__(self, size: int = 1 << 18):
        self.letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))
        self._grow(size)

    def _grow(self, size: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(size + 1, base, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        self.up, self.down = powers(FACTOR), powers(pow(FACTOR, -1, 1 << 64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums for `between`. Bytes get random values; wider integers are mixed."""
        n = len(values)
        if n >= len(self.up):
            self._grow(max(n, 2 * len(self.up)))
        wide = self.letters[values] if values.dtype == np.uint8 else mixed(values.astype(np.uint64) + np.uint64(FACTOR))
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(wide * self.up[:n], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each [start, end)."""
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or greatest) of each `width` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def blocks(sizes: list[int], most: int = 1 << 20):
    """Ranges of items whose sizes together stay under `most`, single items aside."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
