"""Listing cards and detail pages of the same URL made into postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake.functions import text as tx
from hirelake.operators import quality

ELEMENTS = ("location", "description", "apply_url")
REQUIRED = (*ELEMENTS, "job_id")


def latest_details(details: DataFrame, order: str = "captured_at") -> DataFrame:
    """One detail per URL, the newest capture. Each task keeps its newest row per URL before the
    shuffle, so copies fold there."""
    rest = [F.col(c).desc() for c in details.columns if c not in ("job_url", order)]
    newest = W.partitionBy("job_url").orderBy(F.col(order).desc(), *rest)
    return details.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def joined(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Every card with its details, label split into title and id, missing parts listed; a card
    without a detail page lacks `detail`. An element that is there but empty is not missing.

    Shuffle join on the URL; details hold a URL once, and adaptive execution splits a URL
    that very many cards share."""
    pairs = cards.join(details.withColumn("_found", F.lit(True)), "job_url", "left")
    more = [c for c in details.columns if c not in ("job_url", *ELEMENTS)]
    typed = pairs.select(
        "job_url",
        tx.non_empty(F.col("industry")).alias("industry"),
        tx.label_title(F.col("label")).alias("title"),
        tx.label_id(F.col("label")).alias("job_id"),
        tx.stripped(F.col("location")).alias("location"),
        "description",
        "apply_url",
        *more,
        "_found",
    )
    judged = quality.judged(typed, REQUIRED)
    without = F.when(F.col("_found").isNull(), F.array(F.lit("detail"))).otherwise(F.col("missing"))
    return judged.withColumn("missing", without).drop("_found")


def postings(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Postings with every required element."""
    return quality.accepted(joined(cards, details))
