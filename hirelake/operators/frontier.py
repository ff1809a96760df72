"""What to fetch next: priority, de-duplication, allowed domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake.functions import urls
from hirelake.operators.paging import WIDTH, total_before

PAGE_BLOCK = 1_000


def detail_priority(n_links: Column, pos: Column, page_limit: int) -> Column:
    """Links of a full page first: limit + n - i, i counted from 0."""
    return F.lit(page_limit) + n_links - pos


def detail_priority_by_page(page_no: Column, pos: Column) -> Column:
    return page_no - pos


def listing_priority(page_no: Column, page_limit: int | None = None) -> Column:
    """The next listing page comes after the details: limit - page, or page - 5."""
    return page_no - 5 if page_limit is None else F.lit(page_limit) - page_no


def ranked(frontier: DataFrame, page_block: int = PAGE_BLOCK, width: int = WIDTH) -> DataFrame:
    """Fetch order per source: priority from high to low, then page, then position, then URL.

    Rows are numbered inside (source, priority, block of pages), which a page limit or a
    page size bounds. The counts in front are summed by two trees of blocks (see
    paging.total_before): one over the page blocks of each priority, one over the priorities of
    each source, so that a source with a third of all rows, or one with a priority per
    page, is never ordered in one task. The frontier is read twice: hand in a table, not a plan
    that parses pages."""
    blocked = frontier.withColumn("_pages", F.floor(F.col("page_no") / F.lit(page_block)).cast("long"))
    group = ["source", "priority", "_pages"]
    counts = blocked.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    pages = total_before(counts, ["source", "priority"], "_pages", "_n", "_earlier", width).drop("_n")
    steps = counts.groupBy("source", "priority").agg(F.sum("_n").alias("_n")).withColumn("_order", -F.col("priority"))
    higher = total_before(steps, ["source"], "_order", "_n", "_higher", width).select("source", "priority", "_higher")
    offsets = pages.join(higher, ["source", "priority"]).select(*group, (F.col("_earlier") + F.col("_higher")).alias("_before"))
    tie = [c for c in ("url_norm", "url") if c in frontier.columns]
    inside = W.partitionBy(*group).orderBy("page_no", "pos", *tie)
    return (
        blocked.join(offsets, group)
        .withColumn("fetch_rank", (F.row_number().over(inside) + F.col("_before")).cast("long"))
        .drop("_pages", "_before")
    )


def distinct_urls(frontier: DataFrame, url: str = "url") -> DataFrame:
    """One row per source and normalised URL, the earliest by page and position.

    Copies are folded before the shuffle, so a URL found a billion times costs one row
    per input task."""
    keyed = frontier.withColumn("url_norm", urls.normalised(F.col(url)))
    rest = [c for c in keyed.columns if c not in ("source", "url_norm", "page_no", "pos")]
    first = F.min(F.struct("page_no", "pos", *rest)).alias("_first")
    return keyed.groupBy("source", "url_norm").agg(first).select("source", "url_norm", "_first.*")


def unseen(frontier: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct URLs no earlier run has requested. `seen` holds source and url_norm."""
    return distinct_urls(frontier).join(seen.select("source", "url_norm"), ["source", "url_norm"], "left_anti")


def allowed(frontier: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """URLs on an allowed domain of their source or a sub-domain of one.

    Distinct hosts are matched by their suffixes, an equality join; frontier rows then
    meet the hosts that passed. `domains` holds source and domain. The frontier is read
    twice: hand in a table."""
    hosted = frontier.withColumn("_host", urls.host(F.col(url)))
    suffixes = (
        hosted.select("source", "_host").where(F.col("_host").isNotNull()).distinct()
        .select("source", "_host", F.explode(urls.host_suffixes(F.col("_host"))).alias("_suffix"))
    )
    listed = domains.select("source", F.lower("domain").alias("_suffix"))
    passed = suffixes.join(listed, ["source", "_suffix"], "left_semi").select("source", "_host").distinct()
    return hosted.join(passed, ["source", "_host"], "left_semi").drop("_host")


def detail_requests(links: DataFrame, page_limit: int | None) -> DataFrame:
    """Detail requests with priority from `(source, page_no, pos, n_links, url)`."""
    if page_limit is None:
        priority = detail_priority_by_page(F.col("page_no"), F.col("pos"))
    else:
        priority = detail_priority(F.col("n_links"), F.col("pos"), page_limit)
    return links.withColumn("kind", F.lit("detail")).withColumn("priority", priority.cast("long"))


def listing_request_rows(requests: DataFrame, page_limit: int | None) -> DataFrame:
    """Listing requests `(source, page_no, url)`: page p is asked for with the priority
    given when page p - 1 was read."""
    before = F.col("page_no") - 1
    return (
        requests.withColumn("kind", F.lit("listing"))
        .withColumn("pos", F.lit(-1))
        .withColumn("priority", listing_priority(before, page_limit).cast("long"))
    )
