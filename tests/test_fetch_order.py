"""Prefix sums as a tree of blocks: right totals, and no window that sees more rows than it may."""

import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators import frontier, paging


def window_sizes(df):
    """The most rows that one partition of each window of the plan gets."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    sizes, waiting = [], [df._jdf.queryExecution().optimizedPlan()]
    while waiting:
        node = waiting.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        waiting += children
        if node.nodeName() == "Window":
            output = children[0].output()
            ids = [output.apply(i).exprId().id() for i in range(output.size())]
            keys = node.partitionSpec()
            rows = DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, children[0]), spark)
            named = rows.toDF(*(f"c{i}" for i in range(len(ids))))
            by = [f"c{ids.index(keys.apply(i).exprId().id())}" for i in range(keys.size())]
            sizes.append(named.groupBy(*by).count().agg(F.max("count")).first()[0])
    return sizes


@pytest.mark.parametrize("width,spread,levels", [(3, 20, 2), (5, 600, 3), (1000, 10**11, 3), (100, 300, 0)])
def test_totals_over_any_numbers(spark, width, spread, levels):
    pick = random.Random(width)
    rows = [(s, n, pick.randint(-3, 9)) for s in ("a", "b") for n in sorted({pick.randint(-spread, spread) for _ in range(200)})]
    rows += [("c", 2**62 + 1, 5), ("c", -(2**62) - 1, 4), ("c", 0, 1)]
    df = spark.createDataFrame(rows, "source string, n long, v long")
    got = paging.total_before(df, ["source"], "n", "v", "before", width, levels=levels)
    want = [(s, n, v, sum(w for t, m, w in rows if t == s and m < n)) for s, n, v in rows]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("n,step", [(1_000_000, 1), (50_000, 9_000)])
def test_no_window_sees_more_than_its_width(spark, n, step):
    """Priorities of one source, side by side or far apart."""
    width = 1000
    rows = spark.range(n).select(
        F.lit("s").alias("source"), F.col("id").alias("page_no"), F.lit(0).alias("pos"), (F.col("id") * step).alias("priority"),
        F.col("id").cast("string").alias("url"),
    )
    ranked = frontier.ranked(rows, width=width)
    sizes = window_sizes(ranked)
    assert len(sizes) > 4 and max(sizes) <= width
    right = F.count_if(F.col("fetch_rank") == n - F.col("page_no"))
    assert tuple(ranked.agg(F.count("*"), right).first()) == (n, n)


@pytest.mark.parametrize("limit", [None, 20])
def test_rank_equals_one_sort(spark, limit):
    pick = random.Random(4)
    rows = [(s, p, i, 10 + p % 3, f"u{p}-{i}") for s in "ab" for p in pick.sample(range(5_000), 60) for i in range(10 + p % 3)]
    links = spark.createDataFrame(rows, "source string, page_no long, pos int, n_links long, url string")
    got = frontier.ranked(frontier.detail_requests(links, limit), page_block=7, width=5).collect()
    for s in "ab":
        mine = sorted((r for r in got if r["source"] == s), key=lambda r: (-r["priority"], r["page_no"], r["pos"], r["url"]))
        assert [r["fetch_rank"] for r in mine] == list(range(1, len(mine) + 1))
