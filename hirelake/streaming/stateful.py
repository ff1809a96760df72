"""State with timers of the event's time: pages seen within a horizon, and when to try again.

Both keep one small value per key in the RocksDB store (see `incremental.start`) and set a timer for
the moment it changes without a new row, so keys that time has passed leave the state. The watermark
is the latest event time so far less a delay; a timer goes off once the watermark has reached it. A
restart carries state and timers on.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructType

from hirelake.streaming.incremental import with_key

FIRST, LATE = "first", "late"


def _told(row: Row, outcome: str) -> Row:
    values = row.asDict()
    del values["_at"]
    return Row(**values, outcome=outcome)


class _SeenWithin(StatefulProcessor):
    """One state value per key: when it was first seen."""

    def __init__(self, horizon_ms: int) -> None:
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        line = timerValues.getCurrentWatermarkInMs()
        known, first = self.seen.exists(), None
        for row in rows:
            if known:
                continue
            if row["_at"] < line:
                yield _told(row, LATE)
            elif first is None or row["_at"] < first["_at"]:
                first = row
        if first is not None:
            self.seen.update((first["_at"],))
            self.handle.registerTimer(first["_at"] + self.horizon_ms)
            yield _told(first, FIRST)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def seen_within(pages: DataFrame, delay: str, horizon_ms: int, event_time: str = "captured_at", key: tuple = ("source", "url_norm")) -> DataFrame:
    """The first page of each key, and again once the watermark has passed its time by `horizon_ms`;
    `outcome` says `first`. Pages behind the watermark whose key is not in the state come out as
    `late`, none is lost: whether they were seen before can no longer be told. Repeated pages of a
    known key are dropped. Of pages that come together the earliest is the first. A page without
    a time is not behind anything and is left out, as nothing could end its stay in the state; pages
    without a URL share the key null.

    The key's rows of a batch pass one by one, so a key of any size takes no memory."""
    marked = with_key(pages).where(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
    # A computed time does not count as the watermark's column, so late pages reach the operator.
    plain = marked.withColumn(event_time, F.timestamp_micros(F.unix_micros(event_time)))
    schema = StructType(list(plain.schema.fields)).add("outcome", StringType())
    timed = plain.withColumn("_at", F.unix_millis(event_time))
    return timed.groupBy(*key).transformWithState(_SeenWithin(horizon_ms), schema, "Append", "EventTime")


def late_counts(rows: DataFrame, by: tuple = ("source",)) -> DataFrame:
    """Late pages of each source, from the table that `incremental.start` wrote by outcome."""
    return rows.where(F.col("outcome") == LATE).groupBy(*by).agg(F.count(F.lit(1)).alias("n_late"))


class _RetryTimes(StatefulProcessor):
    """One state value per URL: its earliest attempts, at most `most`, and up to when it was told. Each
    call to the store is a message to the JVM and back, so the timer that is set is worked out
    from the value, and nothing is asked for or set that is known or stands already."""

    def __init__(self, most: int, wait_ms: int) -> None:
        self.most, self.wait_ms = most, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getValueState("log", "told long, at array<bigint>, id array<bigint>, failure array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        told, before = self._saved()
        timer = self._ahead(before, told)
        events = list(before)
        for row in rows:
            events.append((row["_at"], row["event_id"], row["failure"]))
            if len(events) >= 2 * self.most:
                events = sorted(events)[: self.most]
        events = sorted(events)[: self.most]
        # Later attempts than the last that counts change nothing.
        if events != before:
            yield from self._due(key, told, timer, events, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        told, events = self._saved()
        # Spark itself takes away the timer that went off, the only one.
        yield from self._due(key, told, None, events, timerValues.getCurrentWatermarkInMs())

    def _saved(self) -> tuple[int, list[tuple]]:
        saved = self.log.get()
        if saved is None:
            return -1, []
        told, at, ids, failure = saved
        return told, list(zip(at, ids, failure, strict=True))

    def _times(self, events: list[tuple]) -> Iterator[tuple[int, int, str]]:
        for n, (at, _, failure) in enumerate(events[: self.most - 1]):
            due = at + (self.wait_ms << n)
            if failure != "ok" and (n + 1 == len(events) or events[n + 1][0] > due):
                yield due, n + 1, failure

    def _ahead(self, events: list[tuple], told: int) -> int | None:
        """The time after `told` for which the timer is set."""
        return min((due for due, _, _ in self._times(events) if due > told), default=None)

    def _due(self, key, told: int, timer: int | None, events: list[tuple], now: int) -> Iterator[Row]:
        """What fell due after `told` and up to `now`; a timer for the next one in place of `timer`."""
        for due, n, failure in self._times(events):
            if told < due <= now:
                yield Row(url=key[0], due_ms=due, attempts=n, last_failure=failure)
        told = max(told, now)
        ahead = self._ahead(events, told)
        if timer != ahead:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if ahead is not None:
                self.handle.registerTimer(ahead)
        at, ids, failure = (list(part) for part in zip(*events, strict=True))
        self.log.update((told, at, ids, failure))

    def close(self) -> None:
        pass


def retry_times(log: DataFrame, most: int, wait_ms: int, delay: str, event_time: str = "ts") -> DataFrame:
    """(url, due_at, attempts, last_failure): attempt n of a URL failed, no attempt followed within
    `wait_ms` times 2 to the power n - 1, and the URL has attempts left of its `most`. A row comes
    out once the watermark has reached its time, whatever the order in which the log arrives
    within `delay`; the result is that of `retry_times_of` over the log. Rows of the log behind the
    watermark are dropped, and counted by Spark (`numRowsDroppedByWatermark`).

    `log` holds url, event_time, event_id, failure. No attempt after the last allowed one matters, so
    a URL's state never exceeds `most` attempts, however often it stands in the log."""
    timed = log.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay).select(
        "url", event_time, F.unix_millis(event_time).alias("_at"), F.col("event_id").cast("long"), "failure"
    )
    schema = "url string, due_ms long, attempts long, last_failure string"
    due = timed.groupBy("url").transformWithState(_RetryTimes(most, wait_ms), schema, "Append", "EventTime")
    return due.select("url", F.timestamp_millis("due_ms").alias("due_at"), "attempts", "last_failure")


def listing_state(pages: DataFrame) -> DataFrame:
    """Per source the first empty page and the last page so far, kept up to date as pages arrive in
    any order. Pages fold before they are shuffled, so one source may have any number."""
    return pages.groupBy("source").agg(
        F.min(F.when(F.col("n_links") == 0, F.col("page_no"))).alias("first_empty"), F.max("page_no").alias("last_page")
    )


def latest_listing_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source, first_empty, last_page) after the last batch completed, from the state store."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select(F.col("key.source").alias("source"), F.col("value.min").alias("first_empty"), F.col("value.max").alias("last_page"))


def before_stop(pages: DataFrame, state: DataFrame) -> DataFrame:
    """Pages in front of their source's first empty page, as far as the state knows it."""
    stops = state.where(F.col("first_empty").isNotNull()).select("source", "first_empty")
    kept = pages.join(stops, "source", "left").where(F.col("first_empty").isNull() | (F.col("page_no") < F.col("first_empty")))
    return kept.drop("first_empty")


def open_listings(state: DataFrame) -> DataFrame:
    """(source, page_no): the page to ask for next of each listing that no empty page has ended."""
    return state.where(F.col("first_empty").isNull()).select("source", (F.col("last_page") + 1).alias("page_no"))
