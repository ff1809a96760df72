"""CSV and Parquet sinks for postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CSV = {"emptyValue": "", "nullValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"}


def check_columns(df: DataFrame, allowed: Sequence[str]) -> None:
    unknown = [c for c in df.columns if c not in allowed]
    if unknown:
        raise ValueError(f"columns not declared: {unknown}")


def rendered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order, everything as text, an absent field as the empty string."""
    check_columns(df, columns)

    def cell(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(col)
        return col.cast("string")

    present = {f.name: cell(f) for f in df.schema.fields}
    return df.select(*[F.coalesce(present.get(c, F.lit("")), F.lit("")).alias(c) for c in columns])


def append_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append rows without a header; an undeclared column is an error."""
    rendered(df, columns).write.mode("append").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What append_csv wrote, empty cells as empty strings. Quoted line breaks are kept."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).options(multiLine="true", escape='"', emptyValue="").csv(path)
    return df.na.fill("")


def write_postings(df: DataFrame, path: str, by: Sequence[str] = ("source",), mode: str = "append",
                   max_records: int = 5_000_000) -> None:
    """Partitioned Parquet in files of even size. The rebalance gathers each partition's
    rows and lets adaptive execution split those of a large board and merge those of small
    ones, so neither one task nor a million small files come of it."""
    (
        df.hint("rebalance", *by).write.mode(mode).option("maxRecordsPerFile", max_records)
        .partitionBy(*by).parquet(path)
    )


def split_write(df: DataFrame, path: str, mode: str = "append") -> None:
    """Accepted and rejected rows in one pass over the input (see quality.judged), each by source
    where there is one."""
    by = ("accepted", "source") if "source" in df.columns else ("accepted",)
    write_postings(df, path, by=by, mode=mode)
