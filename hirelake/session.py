"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def session(app: str = "hirelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC; the cluster's own settings win over everything else here."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Node arrays are larger than the pages they come from; keep their batches small.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode, where none is named. On
    a cluster executors would write to disks of their own, so there it is an error."""
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="hirelake-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), "hirelake", f"{name}-{uuid.uuid4().hex}")


_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe when executors are
    lost, and read back by column. For results that several later steps read."""
    path = scratch(df.sparkSession, name)
    _made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """Collects the paths of the tables that `written` makes in the block, for `removed`."""
    start, paths = len(_made), []
    yield paths
    paths.extend(_made[start:])


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables made by `written` once nothing reads them any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _made[:] = [p for p in _made if p not in paths]
