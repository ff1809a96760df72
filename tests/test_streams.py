"""A stream gives what the batch gives; a restart adds nothing."""

import datetime as dt

import pytest

from hirelake.plans import boards, schema
from hirelake.sources import captures
from hirelake.streaming import incremental

T0 = dt.datetime(2024, 1, 1)


def capture(i, url=None):
    html = f'<h1 id="jdp-title-job-title">Title {i}</h1>'
    return ("paypal", "detail", i, url or f"https://p.com/{i}", html, T0 + dt.timedelta(minutes=i))


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "in")

    def add(rows):
        spark.createDataFrame(rows, captures.CAPTURED_PAGES).repartition(2).write.mode("append").parquet(path)

    return path, add, str(tmp_path)


def run(spark, path, out, make):
    stream = make(captures.page_stream(spark, path, files_per_batch=1))
    incremental.start(stream, f"{out}/rows", f"{out}/ckpt").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def test_stream_equals_batch_over_two_runs(spark, folder):
    path, add, out = folder
    add([capture(i) for i in range(10)])
    make = lambda s: incremental.postings(s, boards.paypal)
    assert run(spark, path, out, make).count() == 10
    assert run(spark, path, out, make).count() == 10
    add([capture(i) for i in range(10, 15)])
    got = run(spark, path, out, make)
    batch = boards.paypal(captures.pages(spark, path))
    cols = ["source", "title", "job_url", "captured_at"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert schema.conform(got).count() == 15


def test_first_seen_survives_restarts(spark, folder):
    path, add, out = folder
    make = lambda s: incremental.first_seen(s.select("source", "url"))
    add([capture(i) for i in range(6)])
    assert run(spark, path, out, make).count() == 6
    add([capture(i, f"https://p.com/{i}#again") for i in range(6)] + [capture(9)])
    assert run(spark, path, out, make).count() == 7


def test_first_seen_within_horizon(spark, folder):
    path, add, out = folder
    make = lambda s: incremental.first_seen_within(s.select("source", "url", "captured_at"), "10 days")
    add([capture(i) for i in range(6)])
    add([capture(i) for i in range(6)])
    assert run(spark, path, out, make).count() == 6


def test_running_counts(spark, folder):
    path, add, out = folder

    def counts():
        stream = incremental.counts(captures.page_stream(spark, path).select("source"))
        incremental.start_counts(stream, f"{out}/n", f"{out}/nc").awaitTermination()
        return [tuple(r) for r in incremental.latest_counts(spark, f"{out}/n").collect()]

    add([capture(i) for i in range(4)])
    assert counts() == [("paypal", 4)]
    add([capture(i) for i in range(4, 7)])
    assert counts() == [("paypal", 7)]


def test_progress_counter(spark, folder):
    path, add, out = folder
    add([capture(i) for i in range(5)])
    stream = incremental.progress_counter(captures.page_stream(spark, path)).select("source", "url")
    query = incremental.start(stream, f"{out}/rows", f"{out}/ckpt")
    query.awaitTermination()
    assert sum(p.observedMetrics["responses"]["responses"] for p in query.recentProgress if p.observedMetrics) == 5


def test_counts_come_from_the_state_alone(spark, folder):
    """Restarts carry the counters on; nothing is written per batch."""
    import glob

    path, add, out = folder
    make = lambda: incremental.counts(captures.page_stream(spark, path, files_per_batch=1).select("source"))
    for i in range(3):
        add([capture(j) for j in range(4 * i, 4 * i + 4)] + [("quest", "detail", i, f"u{i}", "", T0)])
        incremental.start_counts(make(), f"{out}/n", f"{out}/nc").awaitTermination()
        got = sorted(map(tuple, incremental.latest_counts(spark, f"{out}/n").collect()))
        assert got == [("paypal", 4 * i + 4), ("quest", i + 1)]
    assert len(glob.glob(f"{out}/n/*.parquet")) == 1 and not glob.glob(f"{out}/n/batch=*")


def test_metrics_table_has_a_row_per_batch(spark, folder):
    from pyspark.sql import functions as F

    from hirelake.streaming import metrics

    path, add, out = folder
    add([capture(i) for i in range(10)])

    def run_once(every):
        stream = metrics.observed(captures.page_stream(spark, path, files_per_batch=1), "seen", n=F.count(F.lit(1)), top=F.max("page_no"))
        with metrics.MetricsTable(spark, f"{out}/metrics", every) as table:
            table.wait(incremental.start(stream.select("source", "url"), f"{out}/rows", f"{out}/ckpt"))
        return metrics.latest(table.rows())

    first = run_once(every=1)
    assert first.where("metric = 'n'").count() == 2
    assert first.where("metric = 'n'").agg(F.sum("value")).first()[0] == 10
    assert first.where("metric = 'top'").agg(F.max("value")).first()[0] == 9
    add([capture(i) for i in range(10, 13)])
    second = run_once(every=100)
    by = {r["batch"]: r["value"] for r in second.where("metric = 'n'").collect()}
    written = spark.read.parquet(f"{out}/rows").count()
    assert written == 13 and sum(by.values()) == 13 and len(by) == second.where("metric = 'n'").count()


def test_last_report_of_a_batch_counts(spark):
    from hirelake.streaming import metrics

    rows = [("q", "r1", 0, "2024-01-01", "o", "n", 5.0), ("q", "r2", 0, "2024-01-02", "o", "n", 7.0), ("q", "r1", 1, "2024-01-01", "o", "n", 1.0)]
    got = metrics.latest(spark.createDataFrame(rows, metrics.METRICS)).select("batch", "value").collect()
    assert sorted(map(tuple, got)) == [(0, 7.0), (1, 1.0)]


@pytest.mark.parametrize("files", [1, 3])
def test_given_pages_are_a_file_or_a_folder(spark, tmp_path, files):
    import glob
    import os

    from hirelake.catalog import QUERIES

    pages = spark.createDataFrame([(i, f"https://p{i % 2}.com/{i}", f"<title>T{i}</title>") for i in range(6)], captures.PAGES)
    pages.repartition(files).write.parquet(f"{tmp_path}/pages.parquet")
    if files == 1:
        os.makedirs(f"{tmp_path}/one")
        os.link(glob.glob(f"{tmp_path}/pages.parquet/part-*")[0], f"{tmp_path}/one/pages.parquet")
    at = f"{tmp_path}/one" if files == 1 else str(tmp_path)
    rows = lambda name: sorted(map(tuple, QUERIES[name](spark, at).collect()))
    assert sorted((r["page_id"], r["title"]) for r in QUERIES["stream_postings"](spark, at).collect()) == [(i, f"T{i}") for i in range(6)]
    urls = [(f"https://p{i % 2}.com/{i}",) for i in range(6)]
    assert rows("stream_first_seen") == rows("stream_first_seen_within") == sorted(urls)
    assert rows("stream_counts") == [("p0.com", 3), ("p1.com", 3)]
    assert rows("stream_metrics") == [(6, 6 * len("<title>T0</title>"), 6)]
