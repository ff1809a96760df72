"""Periodic run detection: stretches in which the same words come round again and again.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
and at least max(LEAST, TIMES * q) words that neither neighbouring word can extend.

Short periods (up to SCAN) are found by comparing each word with the one q further on. For
longer ones every text is read at several scales, K = 2 * SCAN, 4 * SCAN, ...: each window of
K / 2 consecutive K-grams picks its least hash, the minimizer. A run with K / 2 < q <= K is
TIMES * q long, so it has a window at i and another at i + q; their words are the same, so they
pick at the same place, and K-grams of a run occur q apart and nowhere between, because a
stretch of q or more words determines the phase of a primitive period. So two neighbouring
occurrences of one minimizer, q apart, seed every run; a seed is then compared word by word in
both directions, by growing blocks. Hashes only propose: words decide. A seed's K-grams overlap
or touch, so it lies in a stretch that repeats at least once; text that repeats further apart
proposes nothing.

Defined cases: a null text has no words and no runs; repeated rows each give their result; runs
of different periods may overlap; words are compared as they stand, with their bytes. A very long
text is one row and takes memory in proportion to its words and time n log n. An empty table gives
an empty result. The added columns take the place of input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import packed, unpacked
from hirelake.llm.rolling import sliding

#: Least words of a run, and how often its period must come round.
LEAST, TIMES = 6, 4
#: Longest period found by comparing every word with the one a period further on.
SCAN = 8
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

RUN = "struct<start:bigint,length:bigint,period:bigint>"
Run = tuple[int, int, int]


def numbered(words: list[bytes]) -> np.ndarray:
    """The same number for the same word."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _FACTOR
    return (values ^ (values >> np.uint64(29))) * _MIX


def scanned(ids: np.ndarray, period: int) -> list[Run]:
    """Every stretch of the period, by one comparison of the text with itself."""
    need = max(LEAST, TIMES * period) - period
    if len(ids) - period < need:
        return []
    same = ids[period:] == ids[:-period]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= need
    return [(int(s), int(e - s) + period, period) for s, e in zip(starts[long], ends[long])]


def seeds(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring occurrences of the same minimizer, size / 2 < distance
    <= size. `grams` are hashes of `size` words from each word on."""
    width = size // 2
    least = sliding(grams, width)
    # All that are least in some window, so that windows with the same words pick the same places.
    pad = np.zeros(width - 1, dtype=np.uint64)
    picked = np.flatnonzero(sliding(np.concatenate((pad, least, pad)), width, np.maximum) == grams)
    order = picked[np.argsort(grams[picked], kind="stable")]
    here, there = order[:-1], order[1:]
    apart = there - here
    hit = (grams[here] == grams[there]) & (apart > width) & (apart <= size)
    return here[hit], apart[hit]


def _reach(same: np.ndarray) -> int:
    """How many values are true before the first false one."""
    at = int(np.argmin(same)) if len(same) else 0
    return len(same) if len(same) == 0 or same[at] else at


def extended(ids: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The stretch around `place` in which words `period` apart are identical, as start and
    end (exclusive); empty if the words at `place` differ."""
    last, block = len(ids) - period, 64
    right = place
    while right < last:
        step = min(block, last - right)
        n = _reach(ids[right : right + step] == ids[right + period : right + period + step])
        right += n
        if n < step:
            break
        block *= 2
    left, block = place, 64
    while left > 0:
        step = min(block, left)
        n = _reach((ids[left - step : left] == ids[left - step + period : left + period])[::-1])
        left -= n
        if n < step:
            break
        block *= 2
    return (left, right + period) if right > place else (place, place)


def primitive(block: np.ndarray) -> bool:
    """Whether no shorter block, repeated, makes this one."""
    size, rest, prime = len(block), len(block), 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = size // prime
            if np.array_equal(block[part:], block[:-part]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def runs(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of every run, by start and period."""
    n, found = len(ids), []
    for period in range(1, min(SCAN, n // TIMES) + 1):
        found += scanned(ids, period)
    size = 2 * SCAN
    grams = _mixed(ids.astype(np.uint64) + np.uint64(1))
    span = 1
    while TIMES * (size // 2 + 1) <= n:
        while span < size:  # hashes of twice as many words from those of half
            grams = _mixed(grams[:-span] * _FACTOR + grams[span:])
            span *= 2
        places, apart = seeds(grams, size)
        ended: dict[int, int] = {}
        for at, period in sorted(zip(places.tolist(), apart.tolist())):
            if at + period < ended.get(period, 0):
                continue  # inside the run that this period had last
            start, end = extended(ids, at, period)
            ended[period] = end
            if end - start >= max(LEAST, TIMES * period):
                found.append((start, end - start, period))
        size *= 2
    return sorted({r for r in found if r[2] == 1 or primitive(ids[r[0] : r[0] + r[2]])}, key=lambda r: (r[0], r[2]))


def kept(words: list[bytes], found: list[Run]) -> bytes:
    """The words but those that some run contains after its first period, joined by a space."""
    if not found:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    stays = np.cumsum(edges[:-1]) == 0
    return b" ".join(w for w, keep in zip(words, stays) if keep)


def _finder(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("kept_text", pa.string())])
    for texts in batches:
        out = []
        for text in texts:
            words = (text.as_py() or "").encode().split()
            found = runs(numbered(words))
            out.append({
                "n_words": len(words),
                "runs": [{"start": s, "length": n, "period": q} for s, n, q in found],
                "kept_text": kept(words, found).decode(),
            })
        yield pa.array(out, kind)


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds n_words, `runs` (array<struct<start, length, period>> in words, by start and period)
    and kept_text, the text with each run folded to its first period, to the columns `carry`, all
    of them unless named."""
    carry = docs.columns if carry is None else carry
    udf = F.arrow_udf(_finder, f"struct<n_words:bigint,runs:array<{RUN}>,kept_text:string>")
    made = packed(docs, carry, _text=F.col(text)).select("_in", udf("_text").alias("_r"))
    return unpacked(made.select("_in", "_r.*"), carry, "n_words", "runs", "kept_text")
