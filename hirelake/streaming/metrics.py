"""What streams report as they pass: counts of each batch, in a table.

`observed` hangs aggregates on a stream; they are computed along with the batch, without another
job over its rows. `MetricsTable` is a listener that keeps them: one row per query, batch and metric.
A batch that is done again after a restart reports again under its number; `latest` keeps the last.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS = "query string, run string, batch long, reported_at string, observation string, metric string, value double"


def observed(rows: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """The rows, with aggregates over each batch of them reported under `name`."""
    return rows.observe(name, *(column.alias(metric) for metric, column in metrics.items()))


class MetricsTable(StreamingQueryListener):
    """Appends what the session's queries observe to a table under `path` in the shared folder. A
    report is a handful of numbers; a file is written for each `every` of them and at the end
    of a query."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self._lock, self._rows = threading.Lock(), []
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> MetricsTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure: object) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (str(p.id), str(p.runId), p.batchId, p.timestamp, name, metric, None if value is None else float(value))
            for name, row in p.observedMetrics.items()
            for metric, value in row.asDict().items()
        ]
        with self._lock:
            self._rows += rows
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            made = self.spark.createDataFrame(rows, METRICS).coalesce(1)
            made.write.mode("append").parquet(f"{self.path}/part={uuid.uuid4().hex}")

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all it reported is in the table: reports come later than
        the batches they tell of."""
        query.awaitTermination()
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was reported within {seconds} s")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(METRICS).parquet(f"{self.path}/part=*")


def latest(metrics: DataFrame) -> DataFrame:
    """The last report of each query, batch and metric, that of the last run."""
    last = W.partitionBy("query", "batch", "observation", "metric").orderBy(F.col("reported_at").desc(), F.col("run").desc())
    return metrics.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "run")
