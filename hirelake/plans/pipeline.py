"""Captures to the one postings table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators import quality
from hirelake.plans import boards, schema
from hirelake.sources import json_api

REQUIRED = ("title", "job_url_or_apply")


def _of(pages: DataFrame, board: str, kind: str) -> DataFrame:
    """One board's pages. With captures partitioned by source and kind this reads their
    folder and nothing else."""
    return pages.where((F.col("source") == board) & (F.col("kind") == kind))


def board_postings(pages: DataFrame, board: str) -> DataFrame:
    """Canonical postings of one board from captured pages."""
    details = _of(pages, board, "detail")
    if board == "riteaid":
        return schema.conform(boards.riteaid(_of(pages, board, "listing"), details))
    return schema.conform(boards.BOARDS[board](details))


def all_postings(pages: DataFrame, job_api: DataFrame) -> DataFrame:
    """Postings of the nine boards: eight from pages, one from its JSON API."""
    from_pages = [board_postings(pages, board) for board in [*boards.BOARDS, "riteaid"]]
    return schema.combine([*from_pages, schema.conform(boards.marriott(job_api))])


def all_judged(pages: DataFrame, job_api: DataFrame) -> DataFrame:
    """Postings of the nine boards with `missing` and `accepted`, and nothing left out: cards keep
    the parts that they or their detail page lack, and an API response that cannot be read is
    a rejected row of its own."""
    from_pages = [judged_postings(board_postings(pages, board)) for board in boards.BOARDS]
    found = boards.riteaid_judged(_of(pages, "riteaid", "listing"), _of(pages, "riteaid", "detail"))
    cards = boards.riteaid_fields(found, missing=F.col("missing"), accepted=F.col("accepted"))
    lost = json_api.unreadable(job_api, json_api.slugs()).select(
        F.lit("marriott").alias("source"), "captured_at", "missing", F.lit(False).alias("accepted")
    )
    judged = [*from_pages, judged_postings(schema.conform(boards.marriott(job_api)))]
    return reduce(DataFrame.unionByName, [*judged, *(_judged_columns(x) for x in (cards, lost))])


def _judged_columns(df: DataFrame) -> DataFrame:
    plain = {f.name: f.dataType for f in schema.POSTING.fields}
    columns = [(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in plain.items()]
    return df.select(*columns, "missing", "accepted")


def judged_postings(postings: DataFrame) -> DataFrame:
    """Postings marked accepted or not: a title and one of the two links are required."""
    linked = postings.withColumn("job_url_or_apply", F.coalesce("job_url", "apply_url"))
    return quality.judged(linked, REQUIRED).drop("job_url_or_apply")
