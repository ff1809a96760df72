"""A compressed full-text index over word sequences, searched in bulk with numpy.

The Burrows-Wheeler transform of the text is kept in a wavelet matrix: one bit vector per bit
of a symbol, with counts per 64 bits. Searches run backwards and for many queries in step.
"""

from __future__ import annotations

import numpy as np


def suffixes(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes by prefix doubling, and the ranks by the first 1, 2, 4, .. symbols."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank], 1
    while rank.max(initial=0) < n - 1 and step < 2 * n:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:] if step < n else []
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        step *= 2
    return np.argsort(rank, kind="stable"), levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length that each suffix shares with the one before it in the order; n + 1 values, the ends 0."""
    n = len(order)
    a, b, out = order[:-1].copy(), order[1:].copy(), np.zeros(n + 1, dtype=np.int32)
    shared = np.zeros(max(0, n - 1), dtype=np.int32)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), dtype=bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        a[same] += 1 << k
        b[same] += 1 << k
        shared[same] += 1 << k
    out[1:n] = shared
    return out


class BitRanks:
    """A bit vector that counts its ones in front of any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    def ones(self, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, sigma: int):
        self.n, self.depth = len(values), max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitRanks, int]] = []
        for k in range(self.depth - 1, -1, -1):
            bits = (values >> k & 1).astype(np.uint8)
            self.levels.append((BitRanks(bits), int(len(bits) - bits.sum())))
            values = np.concatenate((values[bits == 0], values[bits == 1]))
        symbols = np.arange(sigma)
        self.start = self._descend(symbols, np.zeros(sigma, dtype=np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ranks, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = ranks.ones(at)
            at = np.where(symbols >> k & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of each place."""
        return self._descend(symbols, at) - self.start[symbols]


class Least:
    """Minima of ranges, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            last, half = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of each [low, high), which must not be empty."""
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=self.rows[0].dtype)
        for p in np.unique(power):
            own = power == p
            row = self.rows[p]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(p))])
        return out


class Index:
    """Sequences of symbols (numbers from 0), each with an owner; smaller owners count as earlier."""

    def __init__(self, pieces: list[np.ndarray], owners: np.ndarray):
        count = len(pieces)
        # Every sequence ends in a symbol of its own, so no match runs over an end.
        self.text = np.concatenate([np.append(p + count, i) for i, p in enumerate(pieces)])
        self.shift = count
        order, levels = suffixes(self.text)
        self.shared = common_prefixes(order, levels)
        self.near = Least(self.shared)
        sigma = int(self.text.max()) + 1
        self.wavelet = WaveletMatrix(self.text[order - 1], sigma)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=sigma))))
        sizes = np.array([len(p) + 1 for p in pieces])
        self.owner = Least(np.repeat(owners, sizes)[order].astype(np.int32))
        self.n = len(self.text)

    def widened(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of all suffixes that share `depth` symbols with those of [low, high)."""
        low, high = low.copy(), high.copy()
        rows = self.near.rows
        for p in range(len(rows) - 1, -1, -1):
            size = 1 << p
            can = low >= size
            can[can] = rows[p][low[can] - size + 1] >= depth[can]
            low[can] -= size
            can = high + size <= self.n
            can[can] = rows[p][high[can]] >= depth[can]
            high[can] += size
        return low, high

    def matches(self, pieces: list[np.ndarray], owners: np.ndarray, most: int) -> list[np.ndarray]:
        """Matching statistics, at most `most`: per query and place, how many symbols from there on
        also stand in a sequence of a smaller owner. All queries advance together, from their last
        symbol to their first."""
        if not pieces:
            return []
        sizes = np.array([len(p) for p in pieces])
        flat, ends = np.concatenate(pieces), np.cumsum(sizes)
        found = np.zeros(len(flat), dtype=np.int32)
        low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), self.n, np.int64)
        depth = np.zeros(len(pieces), np.int64)
        for back in range(1, int(sizes.max(initial=0)) + 1):
            live = np.flatnonzero(sizes >= back)
            full = live[depth[live] == most]
            if len(full):
                depth[full] = most - 1
                low[full], high[full] = self.widened(low[full], high[full], depth[full])
            symbol = flat[ends[live] - back] + self.shift
            wait = np.arange(len(live))
            while len(wait):
                q, c = live[wait], symbol[wait]
                known = c < len(self.below) - 1
                c = np.where(known, c, 0)
                both = self.wavelet.rank(np.concatenate((c, c)), np.concatenate((low[q], high[q])))
                a, b = self.below[c] + both[: len(c)], self.below[c] + both[len(c) :]
                good = known & (a < b)
                good[good] = self.owner.of(a[good], b[good]) < owners[q[good]]
                yes, no = q[good], q[~good]
                low[yes], high[yes] = a[good], b[good]
                depth[yes] += 1
                # The others drop symbols at their right end until one more matches, or none is left.
                more = depth[no] > 0
                wait, no = wait[~good][more], no[more]
                parent = np.maximum(self.shared[low[no]], self.shared[high[no]])
                depth[no] = np.minimum(parent, depth[no] - 1)
                low[no], high[no] = self.widened(low[no], high[no], depth[no])
            found[ends[live] - back] = depth[live]
        return np.split(found, ends[:-1])
