"""Saved state from run to run, and search terms in requests."""

from urllib.parse import quote

import pytest

from hirelake.plans import runs
from hirelake.session import scratch
from hirelake.sources import requests, restated

PAGES = "source string, page_no long, n_links long"


def rows(df):
    return {r.source: (r.page_no, r.jobs_fetched, r.ended) for r in df.collect()}


def test_runs_go_on_from_the_saved_state(spark):
    made = runs.Runs(spark, scratch(spark, "runs"), "riteaid")
    first = [("a", 1, 10), ("a", 2, 10), ("a", 2, 9), ("b", 1, 0), ("c", 1, None)]
    assert rows(made.finish(spark.createDataFrame(first, PAGES), 1)) == {"a": (2, 20, False), "b": (0, 0, True), "c": (1, 0, False)}
    assert {(r.source, r.page_no) for r in runs.following(made.state(2), "riteaid").collect()} == {("a", 3), ("c", 2)}
    again = [("a", 2, 10), ("a", 3, 4), ("a", 4, 0), ("a", 5, 9), ("b", 2, 5), ("d", 1, 1)]
    # A run that breaks off before its manifest leaves the state of the first.
    restated.write_rows(spark.createDataFrame([("a", 99, 99, True)], runs.STATE), made.path, "run-2", "source")
    assert rows(made.state(2))["a"] == (2, 20, False)
    want = {"a": (3, 24, True), "b": (0, 0, True), "c": (1, 0, False), "d": (1, 1, False)}
    assert rows(made.finish(spark.createDataFrame(again, PAGES), 2)) == want
    assert rows(made.finish(spark.createDataFrame([], PAGES), 3)) == want
    assert rows(made.state(4)) == want


@pytest.mark.parametrize("cuts", [(1, 2, 3, 4, 5, 6), (3, 6), (6,)])
def test_state_does_not_depend_on_where_runs_are_cut(spark, cuts):
    pages = [("a", i, 10) for i in range(1, 7)] + [("b", i, 3) for i in range(1, 7)]
    state = spark.createDataFrame([], runs.STATE)
    for cut in cuts:
        seen = [p for p in pages if p[1] <= cut]
        state = runs.after(spark.createDataFrame(seen, PAGES), state, "quest", page_limit=5, link_total=30)
    assert rows(state) == {"a": (3, 30, True), "b": (5, 15, True)}


def test_search_terms(spark):
    terms = ["C++ & R/Go", "a=b?c", "ß $1 \\2 {}", "", None]
    asked = [(s, t, 2) for s in ("monster_sg", "paypal", "lockheed", "nowhere") for t in terms]
    got = {(r.source, r.query, r.page_no): r.url for r in requests.search_requests(spark.createDataFrame(asked, "source string, query string, last_page long")).collect()}
    assert len(got) == 2 * (5 + 5 + 1)
    for term in terms[:4]:
        assert got["monster_sg", term, 2].endswith(f"start=18&sort=1&limit=18&query={quote(term, safe='*')}")
        assert f"keywords={quote(term, safe='*')}&facetcountry" in got["paypal", term, 1]
    assert got["monster_sg", None, 1].endswith("query=Data%20scientist") and got["lockheed", None, 2].endswith("p=2")
