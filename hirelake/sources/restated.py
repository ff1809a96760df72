"""Postings by day in which a day can be written again, all of it or not at all.

A run writes its rows under a folder of its own and then, as its last act, a manifest: one small
table that names the days it stands for and its version. Readers take each day from the run of the
highest version that names it. A run that breaks off has no manifest and is never read; one that is
repeated under its name replaces itself (if it had its manifest already, the repetition must not
break off: give a finished run's second go a new name and a higher version); what older runs hold of a
day stays on disk and is passed over by readers.

Defined cases: a null day is a day of its own; a run of no rows names no day, unless `days` does,
and then those days become empty; of runs of one version the greater name counts; before the first
run there is nothing to read, which is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "run string, version long, day string"


def _paths(path: str, run: str) -> tuple[str, str]:
    return f"{path}/data/run={run}", f"{path}/manifest/run={run}"


def _key(column: str) -> Column:
    return F.col(column).cast("string")


def write_rows(df: DataFrame, path: str, run: str, day: str = "day", max_records: int = 5_000_000) -> None:
    """The first half of a run: its rows, which nobody reads yet. The rebalance makes many files of a
    large day and few of a small one."""
    keyed = df.withColumn("_day", _key(day))
    (
        keyed.hint("rebalance", "_day").write.mode("overwrite").option("maxRecordsPerFile", max_records)
        .partitionBy("_day").parquet(_paths(path, run)[0])
    )


def commit(days: DataFrame, path: str, run: str, version: int, day: str = "day") -> None:
    """The second half: from here on the run's rows are those of `days`."""
    named = days.select(_key(day).alias("day")).distinct()
    rows = named.select(F.lit(run).alias("run"), F.lit(version).cast("long").alias("version"), "day")
    rows.coalesce(1).write.mode("overwrite").parquet(_paths(path, run)[1])


def restate(df: DataFrame, path: str, run: str, version: int, day: str = "day", days: DataFrame | None = None) -> None:
    """Rows of whole days. `days` also names days of which no row is left."""
    spark = df.sparkSession
    write_rows(df, path, run, day)
    # The days come from the folders written, not from another pass over what made the rows.
    kind = df.schema[day].dataType.simpleString()
    named = spark.read.schema(f"`{day}` {kind}, _day string").parquet(_paths(path, run)[0]).select(F.col("_day").alias("day"))
    if days is not None:
        named = named.unionByName(days.select(_key(day).alias("day")))
    commit(named, path, run, version)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The run that counts for each day: run, day. It folds before the shuffle."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/run=*")
    return manifest.groupBy("day").agg(F.max(F.struct("version", "run")).alias("top")).select("day", F.col("top.run").alias("run"))


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Each day once, in the columns of `schema`. Rows of replaced days are scanned and
    dropped by the join: their folders are not pruned, as the manifest is known only when the query runs."""
    rows = spark.read.schema(f"{schema}, run string, _day string").option("basePath", f"{path}/data").parquet(f"{path}/data")
    known = current(spark, path)
    meets = (rows["run"] == known["run"]) & rows["_day"].eqNullSafe(known["day"])
    return rows.join(known, meets, "left_semi").drop("run", "_day")
