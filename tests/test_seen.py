"""The stored table of requested URLs: right across runs and sessions, and never shuffled."""

import pytest

from hirelake.operators.seen import Seen

SCHEMA = "source string, page_no long, pos int, url string"


def urls(df):
    return sorted(r["url_norm"] for r in df.select("url_norm").collect())


def links(spark, numbers, source="s"):
    return spark.createDataFrame([(source, i, 0, f"http://h.com/{i}") for i in numbers], SCHEMA)


@pytest.fixture
def seen(spark, tmp_path):
    yield Seen(spark, f"seen_{tmp_path.name.replace('-', '_')}", str(tmp_path / "seen"), 8)


def nodes(plan):
    waiting, found = [plan], []
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        found.append(node)
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_runs_get_only_what_is_new(spark, seen, tmp_path):
    kept = str(tmp_path / "run")
    seen.unseen(links(spark, range(10))).write.parquet(f"{kept}1")
    first = spark.read.parquet(f"{kept}1")
    assert len(urls(first)) == 10
    seen.remember(first)
    seen.remember(first)  # a run that is repeated
    assert seen.rows().count() == 10
    assert urls(seen.unseen(links(spark, range(10)))) == []
    assert urls(seen.unseen(links(spark, range(5, 12)))) == ["http://h.com/10", "http://h.com/11"]
    assert len(urls(seen.unseen(links(spark, range(10), "other")))) == 10
    # Another session knows the folder, not the table.
    spark.sql(f"drop table {seen.name}")
    again = Seen(spark, seen.name + "_b", seen.path, 8)
    assert urls(again.unseen(links(spark, range(12)))) == ["http://h.com/10", "http://h.com/11"]


def test_the_table_is_not_shuffled(spark, seen):
    seen.remember(links(spark, range(100)).selectExpr("source", "url url_norm"))
    new = seen.unseen(links(spark, range(90, 200)))
    assert new.count() == 100
    plan = nodes(new._jdf.queryExecution().executedPlan())
    over = [n for n in plan if "Exchange" in n.nodeName()]
    assert over and not any("Scan parquet" in m.nodeName() for n in over for m in nodes(n))
    scans = [n.toString() for n in plan if "Scan parquet" in n.nodeName()]
    assert len(scans) == 1 and "SelectedBucketsCount: 8 out of 8" in scans[0]


def test_compacted_table_has_a_file_to_a_bucket(spark, seen, tmp_path):
    for start in (0, 10, 20):
        seen.remember(links(spark, range(start, start + 10)).selectExpr("source", "url url_norm"))
    one = seen.compacted(seen.name + "_c", str(tmp_path / "one"))
    assert urls(one.rows()) == urls(seen.rows()) and one.rows().count() == 30
    assert len(list((tmp_path / "one").glob("*.parquet"))) <= 8 < len(list((tmp_path / "seen").glob("*.parquet")))
    assert urls(one.unseen(links(spark, range(28, 32)))) == ["http://h.com/30", "http://h.com/31"]


def test_null_urls_are_never_remembered(spark, seen):
    odd = spark.createDataFrame([("s", None), (None, "http://h.com/1"), ("s", "http://h.com/1")], "source string, url_norm string")
    seen.remember(odd)
    assert urls(seen.rows()) == ["http://h.com/1", "http://h.com/1"]


def test_both_stop_rules_end_a_listing(spark):
    from hirelake.plans import crawl

    pages = spark.createDataFrame([("a", p, 0 if p == 4 else 10) for p in range(1, 7)], "source string, page_no long, n_links long")
    numbers = lambda df: sorted(r["page_no"] for r in df.collect())
    assert numbers(crawl.read_pages(pages, "cisco", link_total=1000)) == [1, 2, 3]
    assert numbers(crawl.read_pages(pages, "cisco", link_total=20)) == [1, 2]
    assert numbers(crawl.read_pages(pages, "quest", link_total=1000)) == [1, 2, 3, 4, 5, 6]
    assert crawl.next_listing(pages, "cisco", link_total=1000).count() == 0
    assert numbers(crawl.next_listing(pages, "quest", link_total=1000)) == [7]
