"""Days written again: whole, once, and not at all where a run breaks off."""

import pytest

from hirelake.sources import restated

SCHEMA = "source string, id long, day date"


def made(spark, rows):
    return spark.createDataFrame(rows, "source string, id long, d string").selectExpr("source", "id", "cast(d as date) day")


def answer(spark, path):
    return sorted((s, i, str(d)) for s, i, d in restated.read(spark, path, SCHEMA).collect())


def test_days_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path)
    first = made(spark, [("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), ("a", 3, "2024-01-02"), ("a", 4, None)])
    restated.restate(first, path, "one", 1)
    assert answer(spark, path) == [("a", 1, "2024-01-01"), ("a", 3, "2024-01-02"), ("a", 4, "None"), ("b", 2, "2024-01-01")]
    restated.restate(made(spark, [("a", 9, "2024-01-01")]), path, "two", 2)
    assert answer(spark, path) == [("a", 3, "2024-01-02"), ("a", 4, "None"), ("a", 9, "2024-01-01")]
    again = made(spark, [("a", 9, "2024-01-01")])
    restated.restate(again, path, "two", 2)
    assert len(answer(spark, path)) == 3
    restated.restate(again.where("false"), path, "three", 3, days=again)
    assert answer(spark, path) == [("a", 3, "2024-01-02"), ("a", 4, "None")]


def test_broken_run_is_not_read(spark, tmp_path):
    path = str(tmp_path)
    rows = made(spark, [("a", i, "2024-01-01") for i in range(10)])
    restated.restate(rows, path, "one", 1)
    before = answer(spark, path)
    broken = rows.selectExpr("source", "if(id = 7, raise_error('broken'), id) as id", "day")
    with pytest.raises(Exception, match="broken"):
        restated.restate(broken, path, "two", 2)
    assert answer(spark, path) == before
    restated.write_rows(rows, path, "two", "day")
    assert answer(spark, path) == before
    restated.restate(rows, path, "two", 2)
    assert answer(spark, path) == before


def test_older_version_does_not_win(spark, tmp_path):
    path = str(tmp_path)
    restated.restate(made(spark, [("a", 2, "2024-01-01")]), path, "late", 2)
    restated.restate(made(spark, [("a", 1, "2024-01-01"), ("a", 1, "2024-01-02")]), path, "early", 1)
    assert answer(spark, path) == [("a", 1, "2024-01-02"), ("a", 2, "2024-01-01")]
