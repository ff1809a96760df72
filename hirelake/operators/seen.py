"""URLs that earlier runs have requested, as a stored table of buckets.

The table is cut by (source, url_norm) when it is written, so a run that asks which of its
URLs are new shuffles its own URLs and never the table, however long the crawl has gone on. A run
appends what it has requested; each run adds one sorted file to each bucket, and `compacted`
makes one file of them again. A hot source is spread over all buckets, as the URL is part of the
key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.frontier import distinct_urls

KEY = ("source", "url_norm")


class Seen:
    """`path` is in the shared folder and outlives the session; `name` is what the table is called
    in this one. The number of buckets is fixed when the table is first made; it should be
    no less than spark.sql.shuffle.partitions, or a join with many more partitions on the other
    side deals out the table again."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 1024) -> None:
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        keys = ", ".join(KEY)
        spark.sql(
            f"create table if not exists {name} (source string, url_norm string) using parquet "
            f"clustered by ({keys}) sorted by ({keys}) into {buckets} buckets location '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, frontier: DataFrame, url: str = "url") -> DataFrame:
        """Distinct URLs of the frontier that are not in the table."""
        return distinct_urls(frontier, url).join(self.rows().hint("merge"), list(KEY), "left_anti")

    def remember(self, requests: DataFrame) -> None:
        """Adds the requests' URLs. Those that are in the table already are not added again, so a
        run that broke off and is repeated leaves the same table. `requests` must not be a plan
        that reads the table: hand in what was written."""
        fresh = requests.select(*KEY).where(F.col("url_norm").isNotNull()).distinct()
        new = fresh.join(self.rows().hint("merge"), list(KEY), "left_anti")
        self._write(new, self.name, self.path, "append")

    def compacted(self, name: str, path: str) -> Seen:
        """The same URLs in a new table with one file to a bucket. The files are read as plain
        ones, so that the rows are dealt out again."""
        self._write(self.spark.read.schema(self.rows().schema).parquet(self.path), name, path, "errorifexists")
        return Seen(self.spark, name, path, self.buckets)

    def _write(self, rows: DataFrame, name: str, path: str, mode: str) -> None:
        dealt = rows.repartition(self.buckets, *KEY)
        (
            dealt.write.mode(mode).format("parquet").option("path", path)
            .bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        )
