"""Captured pages and payloads as tables, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PAGES = T.StructType().add("page_id", "long").add("url", "string").add("html", "string")
CAPTURED_PAGES = (
    T.StructType()
    .add("source", "string")
    .add("kind", "string")
    .add("page_no", "long")
    .add("url", "string")
    .add("html", "string")
    .add("captured_at", "timestamp")
)


def pages(spark: SparkSession, path: str, schema: T.StructType = CAPTURED_PAGES) -> DataFrame:
    """Captured pages. The url stays on every row as provenance."""
    return spark.read.schema(schema).parquet(path)


def spread(pages: DataFrame, key: str = "url") -> DataFrame:
    """Reading pages costs far more than moving them. Where the files give fewer tasks than
    the cluster has cores, the table is small: share it out. Larger input stays as it is.
    `pages` is a scan with narrow steps; asking for its tasks plans it but runs nothing."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages if pages.rdd.getNumPartitions() >= cores else pages.repartition(cores, key)


def page_stream(
    spark: SparkSession, path: str, schema: T.StructType = CAPTURED_PAGES, pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """The same table as a stream of newly arriving files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """API payload captures: one JSON document per line, kept whole in `body`."""
    return spark.read.text(path).withColumnRenamed("value", "body")
