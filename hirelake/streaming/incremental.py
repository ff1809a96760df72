"""Incremental runs over arriving captures. Where the last run ended is the checkpoint;
what has been seen is the de-duplication state. Both live in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelake.functions import urls

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def with_key(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.withColumn("url_norm", urls.normalised(F.col(url)))


def first_seen(pages: DataFrame, key: tuple = ("source", "url_norm")) -> DataFrame:
    """Each page once, across restarts and for good. The state is one key per URL ever
    seen; run it on the RocksDB store (see `start`), which keeps it on disk."""
    return with_key(pages).dropDuplicates(list(key))


def first_seen_within(pages: DataFrame, horizon: str, event_time: str = "captured_at",
                      key: tuple = ("source", "url_norm")) -> DataFrame:
    """Each page once per horizon: copies that arrive within it are dropped and older keys
    leave the state, so a URL may come again later."""
    return with_key(pages).withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(key))


def postings(pages: DataFrame, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Extraction on each arriving page: the batch plan, unchanged."""
    return extract(pages)


def counts(rows: DataFrame, by: tuple = ("source",)) -> DataFrame:
    """Running counters per source."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def start(stream: DataFrame, path: str, checkpoint: str, by: tuple = ("source",)) -> StreamingQuery:
    """Append what is new to Parquet, then stop. The file sink and the checkpoint together
    write each row once, also after a restart."""
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return (
            stream.writeStream.format("parquet").partitionBy(*by)
            .option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def start_counts(stream: DataFrame, path: str, checkpoint: str, by: tuple = ("source",)) -> StreamingQuery:
    """Keep the counters of `counts` up to date. They are the query's own state, which a restart
    carries on, so nothing else is written but `path`, a row that says where the state is."""
    spark = stream.sparkSession
    where = spark.range(1).select(F.lit(checkpoint).alias("checkpoint"))
    where.coalesce(1).write.mode("overwrite").parquet(path)
    return (
        stream.writeStream.format("noop").option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def latest_counts(spark: SparkSession, path: str, by: tuple = ("source",)) -> DataFrame:
    """The counters after the last batch that was completed, read from the state store: one row per
    key, however many batches there have been."""
    checkpoint = spark.read.parquet(path).first()["checkpoint"]
    state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select(*(F.col("key")[c].alias(c) for c in by), F.col("value.count").alias("n"))


def progress_counter(pages: DataFrame, name: str = "responses") -> DataFrame:
    """Counts responses handled as they pass, without another job over the rows."""
    return pages.observe(name, F.count(F.lit(1)).alias("responses"))
