"""Query registration and access to the tables."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from hirelake.catalog.shapes import SHAPES
from hirelake.sources import captures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register the function under its own name; `oracle` is the checking SQL."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured pages, shared out over the cores."""
    return captures.spread(table(spark, sf_dir, "pages"))


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table that pages are written from, shared out before the pages exist."""
    return captures.spread(table(spark, sf_dir, name), key)


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in the form a job reads, made by Spark SQL from the given tables."""
    text = SHAPES[name]
    names = {field for _, field, _, _ in Formatter().parse(text) if field}
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in names})


def shape_sql(name: str) -> str:
    """The same form as a subquery for the checking SQL."""
    text = SHAPES[name]
    names = {field for _, field, _, _ in Formatter().parse(text) if field}
    return "(" + text.format(**{t: t for t in names}) + ")"
