"""Stop rules, running totals and resuming. Input is one row per listing page,
`(source, page_no, n_links)`.

One source may own a third of all pages, so nothing here orders a whole source in one
task: running totals are taken in blocks of numbers, the blocks' sums in blocks of blocks, and
so on up, a tree whose windows see at most `width` rows each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WIDTH = 10_000
#: Levels of blocks above the lowest one: enough for numbers up to 10^12, which page numbers and
#: priorities stay far below.
LEVELS = 2


def total_before(
    df: DataFrame, by: Sequence[str], order: str, value: str, name: str, width: int = WIDTH, then: Sequence[str] = (),
    levels: int = LEVELS,
) -> DataFrame:
    """Sum of `value` over the rows in front, per `by`, in `order` (an integer column,
    negative numbers allowed) and then `then`.

    Rows of a block share `by` and floor(order / width); blocks of a block share the same of their
    own numbers, and so on for `levels`. The topmost window sees no more than twice `width` blocks
    either while `order` is within width ** (levels + 1) of zero; beyond that totals are still
    right. Rows of the same order stand in the same block, however many they are: count them before."""
    blocked = df.withColumn("_block", _blocks(F.col(order), width))
    sums = blocked.groupBy(*by, "_block").agg(F.sum(value).alias("_sum"))
    in_block = W.partitionBy(*by, "_block").orderBy(order, *then).rowsBetween(W.unboundedPreceding, -1)
    return (
        blocked.join(_offsets(sums, by, width, levels), [*by, "_block"])
        .withColumn(name, (F.col("_offset") + F.coalesce(F.sum(value).over(in_block), F.lit(0))).cast("long"))
        .drop("_block", "_offset")
    )


def _blocks(number: Column, width: int) -> Column:
    """floor(number / width) in whole numbers: a double cannot hold every long."""
    number, size = number.cast("long"), F.lit(width).cast("long")
    return F.call_function("div", number - F.pmod(number, size), size)


def _offsets(sums: DataFrame, by: Sequence[str], width: int, levels: int) -> DataFrame:
    """(by, _block, _offset): what the blocks in front of each block add up to."""
    if levels == 0:
        in_front = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        return sums.select(*by, "_block", F.coalesce(F.sum("_sum").over(in_front), F.lit(0)).alias("_offset"))
    grouped = sums.withColumn("_up", _blocks(F.col("_block"), width))
    uppers = grouped.groupBy(*by, "_up").agg(F.sum("_sum").alias("_sum")).withColumnRenamed("_up", "_block")
    above = _offsets(uppers, by, width, levels - 1).select(*by, F.col("_block").alias("_up"), F.col("_offset").alias("_above"))
    in_front = W.partitionBy(*by, "_up").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offset = F.col("_above") + F.coalesce(F.sum("_sum").over(in_front), F.lit(0))
    return grouped.join(above, [*by, "_up"]).select(*by, "_block", offset.alias("_offset"))


def within_page_limit(pages: DataFrame, limit: int) -> DataFrame:
    return pages.where(F.col("page_no") <= limit)


def until_total(pages: DataFrame, total: int | Column, width: int = WIDTH) -> DataFrame:
    """Page 1, and every page for which the links of the pages before stay below the total. A
    page whose total is not known does not end the listing."""
    bound = F.lit(total) if isinstance(total, int) else total
    before = total_before(pages, ["source"], "page_no", "n_links", "links_before", width)
    return before.where((F.col("page_no") == 1) | bound.isNull() | (F.col("links_before") < bound))


def until_first_empty(pages: DataFrame) -> DataFrame:
    """Pages in front of the source's first empty page. A page that cannot be read has a null
    count and is not an empty one."""
    first = pages.groupBy("source").agg(F.min(F.when(F.col("n_links") == 0, F.col("page_no"))).alias("_first"))
    return (
        pages.join(first, "source")
        .where(F.col("_first").isNull() | (F.col("page_no") < F.col("_first")))
        .drop("_first")
    )


def crawl_state(pages: DataFrame) -> DataFrame:
    """Where each source stands: last page and links fetched so far."""
    return pages.groupBy("source").agg(
        F.max("page_no").alias("page_no"), F.sum("n_links").cast("long").alias("jobs_fetched")
    )


def resume(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Requests from the saved page on; a source without state starts at its beginning."""
    saved = state.select("source", F.col("page_no").alias("_from"), F.col("jobs_fetched").alias("fetched_before"))
    return (
        requests.join(saved, "source", "left")
        .where(F.col("page_no") >= F.coalesce(F.col("_from"), F.col("page_no")))
        .withColumn("fetched_before", F.coalesce("fetched_before", F.lit(0)).cast("long"))
        .drop("_from")
    )
