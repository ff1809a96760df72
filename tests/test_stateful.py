"""Keyed state with timers: horizons, late pages, retry times, listings that end out of order."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from hirelake.operators import paging
from hirelake.streaming import incremental, stateful

T0 = dt.datetime(2024, 1, 1)
MINUTE = 60_000


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


class Feed:
    """A folder that files are added to, and the stream over it, one file a batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")

    def run(self, rows, by=("outcome",)):
        query = incremental.start(rows, f"{self.path}/rows", f"{self.path}/checkpoint", by)
        query.awaitTermination()
        return query


PAGES = "source string, url string, captured_at timestamp, outcome2 string"


def test_horizon_late_pages_and_restart(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), PAGES)

    def run():
        feed.run(stateful.seen_within(feed.stream(), "10 minutes", 60 * MINUTE))
        rows = spark.read.parquet(f"{feed.path}/rows")
        return sorted(((r["url"], r["captured_at"], r["outcome"]) for r in rows.collect()), key=str)

    def state():
        table = spark.read.format("statestore").option("path", f"{feed.path}/checkpoint").option("stateVarName", "seen").load()
        return sorted((r["key"]["url_norm"] for r in table.select("key").collect()), key=str)

    feed.add([("b", "https://b.com/1", minutes(0), "x"), ("b", "https://b.com/1#again", minutes(5), "x"), ("b", "https://b.com/2", minutes(50), None)])
    assert run() == [("https://b.com/1", minutes(0), "first"), ("https://b.com/2", minutes(50), "first")]
    assert state() == ["https://b.com/1", "https://b.com/2"]
    # The watermark stands at 40: page 3 is late, page 1 is known, as its hour is not over.
    feed.add([("b", "https://b.com/3", minutes(30), "x"), ("b", "https://b.com/3", minutes(31), "x"), ("b", "https://b.com/1", minutes(45), "x"), ("b", None, minutes(50), "x")])
    got = run()
    assert [r for r in got if r[2] == "late"] == [("https://b.com/3", minutes(30), "late"), ("https://b.com/3", minutes(31), "late")]
    assert len(got) == 5
    assert [tuple(r) for r in stateful.late_counts(spark.read.parquet(f"{feed.path}/rows")).collect()] == [("b", 2)]
    # Once the watermark is beyond 60, page 1 leaves the state and may come again.
    feed.add([("b", "https://b.com/9", minutes(75), "x"), ("c", "https://b.com/1", None, "x")])
    run()
    assert "https://b.com/1" not in state()
    feed.add([("b", "https://b.com/1", minutes(80), "x")])
    assert ("https://b.com/1", minutes(80), "first") in run()
    feed.add([("b", "https://b.com/9", minutes(300), "x")])
    run()
    assert state() == []


LOG = "url string, ts timestamp, event_id long, failure string"


def due_by_hand(log, most, wait, line):
    out = []
    for url, rows in itertools.groupby(sorted(log, key=lambda r: (r[0], r[1], r[2])), key=lambda r: r[0]):
        rows = list(rows)
        for n, row in enumerate(rows[: most - 1]):
            due = row[1] + dt.timedelta(minutes=wait * 2**n)
            after = rows[n + 1][1] if n + 1 < len(rows) else None
            if row[3] != "ok" and (after is None or after > due) and due <= line:
                out.append((url, due, n + 1, row[3]))
    return sorted(out)


@pytest.mark.parametrize("order", ["in time", "mixed within the delay"])
def test_retry_times_equal_the_log_read_by_hand(spark, tmp_path, order):
    some = random.Random(5)
    log = [(f"u{some.randrange(6)}", minutes(t), i, some.choice(["ok", "http", "timeout"])) for i, t in enumerate(sorted(some.randrange(600) for _ in range(90)))]
    log += [("hot", minutes(t), 1000 + t, "dns") for t in range(0, 600, 2)]
    log.sort(key=lambda r: r[1] if order == "in time" else r[1] + dt.timedelta(minutes=some.randrange(25)))
    feed = Feed(spark, str(tmp_path), LOG)
    for half in range(2):
        for i in range(2):
            n = len(log) // 4 * (2 * half + i)
            feed.add(log[n : n + len(log) // 4] if (half, i) != (1, 1) else log[n:])
            query = feed.run(stateful.retry_times(feed.stream(), 5, 7 * MINUTE, "30 minutes"), ())
    got = sorted(map(tuple, spark.read.parquet(f"{feed.path}/rows").collect()))
    line = max(r[1] for r in log) - dt.timedelta(minutes=30)
    assert got == due_by_hand(log, 5, 7, line) and got
    # A URL of 300 attempts keeps five of them.
    state = spark.read.format("statestore").option("path", f"{feed.path}/checkpoint").option("stateVarName", "log").load()
    assert state.select(F.max(F.size("value.at"))).first()[0] == 5
    assert query.exception() is None


def test_retry_waits_for_its_time(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), LOG)

    def run():
        feed.run(stateful.retry_times(feed.stream(), 3, 10 * MINUTE, "0 minutes"), ())
        return sorted((r["url"], r["attempts"]) for r in spark.read.parquet(f"{feed.path}/rows").collect())

    feed.add([("a", minutes(0), 1, "http"), ("b", minutes(0), 2, "http"), ("c", minutes(1), 3, "ok")])
    assert run() == []
    feed.add([("b", minutes(5), 4, "ok"), ("c", minutes(9), 5, "ok")])
    assert run() == []
    feed.add([("c", minutes(11), 6, "ok")])
    assert run() == [("a", 1)]
    feed.add([("a", minutes(12), 7, "http"), ("c", minutes(31), 8, "ok")])
    assert run() == [("a", 1)]
    feed.add([("c", minutes(33), 9, "ok"), ("c", None, 10, "http")])
    assert run() == [("a", 1), ("a", 2)]
    feed.add([("a", minutes(34), 11, "http"), ("c", minutes(500), 12, "ok")])
    assert run() == [("a", 1), ("a", 2)]


class Store:
    """Value state and timers of one key, with a list of the calls made."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):
        self.calls.append("list")
        return iter(self.timers)

    def registerTimer(self, at):
        self.calls.append("register")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("delete")
        self.timers.discard(at)


def test_retry_times_ask_the_store_no_more_than_they_must():
    store, one = Store(), stateful._RetryTimes(3, 10)
    one.init(store)

    def calls(rows, now, expired=None):
        store.calls.clear()
        line = TimerValues(-1, now)
        if expired is None:
            rows = [Row(_at=at, event_id=i, failure=f) for at, i, f in rows]
            out = list(one.handleInputRows(("u",), iter(rows), line))
        else:
            out = list(one.handleExpiredTimer(("u",), line, ExpiredTimerInfo(expired)))
            store.timers.discard(expired)
        return [(r["due_ms"], r["attempts"]) for r in out], store.calls

    assert calls([(0, 1, "http")], 0) == ([], ["get", "register", "update"]) and store.timers == {10}
    assert calls([(5, 2, "ok")], 0) == ([], ["get", "delete", "update"]) and store.timers == set()
    assert calls([(4, 3, "dns")], 0) == ([], ["get", "update"])
    assert calls([(9, 4, "ok")], 0) == ([], ["get"])
    store.value = None
    assert calls([(0, 1, "http")], 0) == ([], ["get", "register", "update"])
    assert calls((), 12, 10) == ([(10, 1)], ["get", "update"]) and store.timers == set()
    assert calls([(20, 2, "dns")], 12) == ([], ["get", "register", "update"]) and store.timers == {40}
    assert calls([(15, 3, "ok")], 13) == ([], ["get", "delete", "update"]) and store.timers == set()


LISTING = "source string, page_no long, n_links long"


@pytest.mark.parametrize("seed", range(3))
def test_listing_ends_at_its_first_empty_page_in_every_order(spark, tmp_path, seed):
    pages = [("a", n, 0 if n in (4, 6) else 3) for n in range(1, 8)] + [("b", n, 2) for n in range(1, 4)]
    pages += [("c", 1, 0), ("d", 1, None), ("d", 3, 1)]
    random.Random(seed).shuffle(pages)
    feed = Feed(spark, str(tmp_path), LISTING)
    for n in range(0, len(pages), 5):
        feed.add(pages[n : n + 5])
        incremental.start_counts(stateful.listing_state(feed.stream()), f"{feed.path}/where", f"{feed.path}/checkpoint").awaitTermination()
        so_far = spark.createDataFrame(pages[: n + 5], LISTING)
        state = stateful.latest_listing_state(spark, f"{feed.path}/checkpoint")
        got = sorted(map(tuple, stateful.before_stop(so_far, state).select("source", "page_no").collect()))
        assert got == sorted(map(tuple, paging.until_first_empty(so_far).select("source", "page_no").collect()))
    assert sorted(map(tuple, stateful.open_listings(state).collect())) == [("b", 4), ("d", 4)]
