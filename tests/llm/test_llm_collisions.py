"""Words whose rolling hashes are equal are different words all the same."""

import numpy as np
import pytest
from cases import documents

from hirelake.llm import lm, substring
from hirelake.llm.rolling import Rolling


def twins(size):
    """Thue-Morse words over two letters and their complements."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_twins_collide_under_the_rolling_hash(size):
    rolling, values = Rolling(), []
    for word in twins(size):
        raw = np.frombuffer(word.encode(), np.uint8)
        values.append(rolling.between(rolling.prefix(raw), np.array([0]), np.array([size]))[0])
    assert values[0] == values[1]


@pytest.mark.parametrize("size", [1024, 4096])
def test_windows_that_differ_in_one_word_stay(spark, size):
    one, two = twins(size)
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join([*words[:20], one, *words[21:]])), (2, " ".join([*words[:20], two, *words[21:]]))]
    rows += [(3, rows[0][1] + " more"), (4, "x " + rows[1][1])]
    for crowd in (2000, 0):
        got = {r["doc_id"]: r["n_removed"] for r in substring.dedupe(documents(spark, rows), crowd=crowd).collect()}
        assert got == {1: 0, 2: 0, 3: 50, 4: 50}


@pytest.mark.parametrize("size", [1024, 4096])
def test_language_model_tells_them_apart(spark, size):
    one, two = twins(size)
    rows = [(1, f"x y {one}"), (2, f"x y {two}"), (3, "x y z"), (4, f"y {two} y {two}")]
    got = {r["doc_id"]: r["n_backoff"] for r in lm.score(documents(spark, rows)).collect()}
    assert got == {1: 2, 2: 1, 3: 2, 4: 2}
