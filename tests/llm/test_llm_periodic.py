"""Periodic runs against a search of every period in plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from cases import CLASHES, documents, texts

from hirelake.llm import periodic, queries


def brute(words):
    """(start, length, period) of every run."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                block = words[i : i + q]
                if not any(q % d == 0 and block == block[:d] * (q // d) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(pick):
    """Words with planted runs of all kinds of periods, some broken, nested or touching."""
    out = []
    for _ in range(pick.randint(1, 6)):
        kind = pick.randrange(4)
        alphabet = pick.choice(["ab", "abc", "abcdefghij", [f"w{i}" for i in range(400)]])
        if kind == 0:
            out += [pick.choice(alphabet) for _ in range(pick.randint(0, 60))]
        else:
            block = [pick.choice(alphabet) for _ in range(pick.choice([1, 2, 3, 5, 8, 9, 12, 16, 17, 31, 33, 40, 64, 65]))]
            if kind == 3:
                block = block * pick.randint(1, 4) + block[: pick.randint(0, len(block))]
            out += (block * 7)[: pick.randint(3 * len(block), 7 * len(block))]
            if kind == 2:
                out[pick.randrange(len(out))] = "broken"
    return out


def test_runs_equal_brute_force():
    pick = random.Random(5)
    for _ in range(600):
        words = made(pick)
        assert periodic.runs(periodic.numbered([w.encode() for w in words])) == brute(words), words


@pytest.mark.parametrize("period", [1, 7, 8, 9, 15, 16, 17, 100, 1000, 4097])
def test_every_period_is_found_at_its_edge(period):
    block = [f"w{i}" for i in range(period)]
    length = max(6, 4 * period)
    words = ["x"] + (block * 7)[:length] + ["y"]
    ids = periodic.numbered([w.encode() for w in words])
    assert periodic.runs(ids) == [(1, length, period)]
    assert periodic.runs(ids[:-2]) == []


def test_one_word_repeated_very_often():
    ids = periodic.numbered([b"a"] * 300_000)
    assert periodic.runs(ids) == [(0, 300_000, 1)]


def looped(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.decode() for w in words]


def expected(doc_id, text):
    words = looped(doc_id, text)
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query(spark, tmp_path):
    """The registered query on awkward texts, among them many whose tails are made to repeat."""
    rows = [r for r in texts() if r[1] is None or len(r[1]) < 20_000]
    loops = [i for i in range(10_000, 14_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, t) for i, (_, t) in zip(loops, rows * 5)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((expected(*r) for r in rows), key=repr)
    assert sum(r[1] for r in want) > 50
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_empty_and_clashing(spark):
    assert periodic.find(documents(spark, [])).collect() == []
    mixed = [(1, "a b a b a b a b"), (1, "a b a b a b a b"), (None, None), (2, "  x  y")]
    got = periodic.find(documents(spark, mixed, (*CLASHES, "runs", "kept_text", "_r", "n_words2")))
    assert [c for c in got.columns if c in ("runs", "kept_text", "n_words")] == ["n_words", "runs", "kept_text"]
    made = sorted((r["doc_id"] or 0, r["n_words"], len(r["runs"]), r["kept_text"], r["_r"]) for r in got.collect())
    assert made == [
        (0, 0, 0, "", "own _r"), (1, 8, 1, "a b", "own _r"), (1, 8, 1, "a b", "own _r"), (2, 2, 0, " x  y", "own _r"),
    ]
