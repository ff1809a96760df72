"""Hashes of runs of words, and the least ones of every window (winnowing)."""

from __future__ import annotations

import numpy as np

from hirelake.llm.rolling import Rolling, sliding


class Words:
    """The words of several normal texts as one array of places."""

    def __init__(self, texts: list[bytes], rolling: Rolling):
        self.counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts])
        self.data = b" ".join(t for t in texts if t)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate(([0], gaps + 1)) if self.data else gaps
        self.ends = np.append(gaps, len(raw)) if self.data else gaps
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.sums, self.rolling = rolling.prefix(raw), rolling

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each word on, and whether they are in one text."""
        n = max(0, len(self.starts) - size + 1)
        hashes = self.rolling.between(self.sums, self.starts[:n], self.ends[size - 1 : size - 1 + n])
        return hashes, self.text[:n] == self.text[size - 1 : size - 1 + n]

    def winnowed(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the least run of `gram` words in every window (all of them where several are
        least), and their hashes."""
        width = window - gram + 1
        hashes, _ = self.runs(gram)
        n = len(self.starts) - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least = sliding(hashes, width).copy()
        least[self.text[:n] != self.text[window - 1 : window - 1 + n]] = 0
        pad = np.zeros(width - 1, dtype=np.uint64)
        places = np.flatnonzero(sliding(np.concatenate((pad, least, pad)), width, np.maximum) == hashes)
        return places, hashes[places]

    def near(self, place: int, size: int, reach: int) -> tuple[int, int, str]:
        """Place in its text, first word, and words of what lies within `reach` words of a run."""
        own = self.text[place]
        low, high = max(self.first[own], place - reach), min(self.first[own + 1], place + size + reach)
        words = self.data[self.starts[low] : self.ends[high - 1]].decode()
        return int(place - self.first[own]), int(low - self.first[own]), words
