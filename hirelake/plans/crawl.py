"""Captured listing pages to the next detail requests of a board."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import urls
from hirelake.operators import frontier, paging, quality
from hirelake.operators.seen import Seen
from hirelake.plans import boards
from hirelake.plans.rules import ATTEMPTS, DOMAINS, PAGE_LIMITS, UNTIL_EMPTY
from hirelake.session import written
from hirelake.sources.requests import LISTINGS


def allowed_domains(spark: SparkSession) -> DataFrame:
    rows = [(board, domain) for board, domains in DOMAINS.items() for domain in domains]
    return spark.createDataFrame(rows, "source string, domain string")


def read_pages(pages: DataFrame, board: str, page_limit: int | None = None, link_total: int | None = None) -> DataFrame:
    """Listing pages up to where the listing ends: behind `page_limit` pages or `link_total` links
    if the caller sets them (rules.PAGE_LIMITS and rules.LINK_CAPS hold what each board was
    first crawled with), and before the first empty page where the board ends like that."""
    if page_limit is not None:
        pages = paging.within_page_limit(pages, page_limit)
    counts = pages.select("source", "page_no", "n_links")
    if link_total is None and board not in UNTIL_EMPTY:
        return pages
    kept = counts
    if board in UNTIL_EMPTY:
        kept = paging.until_first_empty(kept)
    if link_total is not None:
        kept = paging.until_total(kept, link_total)
    return pages.join(kept.select("source", "page_no"), ["source", "page_no"], "left_semi")


def detail_frontier(
    listings: DataFrame, seen: DataFrame | Seen, board: str, page_limit: int | None = None, link_total: int | None = None
) -> DataFrame:
    """Ranked detail requests no earlier run has made (`seen`: source and url_norm, as rows or as
    the stored table), on the board's own domains. `listings` are
    captured pages, or API responses with a `body` for the boards that page by JSON.

    Listing pages are parsed once, into a table of links; so are the new requests, which
    ranking reads twice."""
    pages = _listing_table(listings, board)
    return _ranked(_details(pages, seen, board, page_limit, link_total), board)


def all_requests(
    listings: DataFrame, seen: DataFrame | Seen, board: str, page_limit: int | None = None, link_total: int | None = None
) -> DataFrame:
    """detail_frontier and the request for the listing's next page, ranked together: the next
    page has a priority of its own, given when the page in front of it was read."""
    pages = _listing_table(listings, board)
    template, first, step = LISTINGS[board]
    number = F.lit(first) + (F.col("page_no") - 1) * F.lit(step)
    following = next_listing(pages, board, page_limit, link_total).select(
        "source", "page_no", F.replace(F.lit(template), F.lit("{}"), number.cast("string")).alias("url")
    )
    rows = frontier.listing_request_rows(following, PAGE_LIMITS.get(board)).withColumn("url_norm", urls.normalised(F.col("url")))
    details = _details(pages, seen, board, page_limit, link_total)
    columns = ["source", "kind", "url", "url_norm", "page_no", F.col("pos").cast("long").alias("pos"), "priority"]
    return _ranked(details.select(*columns).unionByName(rows.select(*columns)), board)


def _listing_table(listings: DataFrame, board: str) -> DataFrame:
    found = boards.api_pages(listings, board) if board in boards.API_PAGES else boards.listing_pages(listings, board)
    return written(found, f"{board}-listing")


def _details(pages: DataFrame, seen: DataFrame | Seen, board: str, page_limit: int | None, link_total: int | None) -> DataFrame:
    links = boards.page_links(read_pages(pages, board, page_limit, link_total), board)
    if board in DOMAINS:
        links = frontier.allowed(links, allowed_domains(pages.sparkSession))
    fresh = (seen.unseen if isinstance(seen, Seen) else partial(frontier.unseen, seen=seen))(links.drop("href"))
    return frontier.detail_requests(fresh, PAGE_LIMITS.get(board))


def _ranked(requests: DataFrame, board: str) -> DataFrame:
    ranked = frontier.ranked(written(requests, f"{board}-requests"))
    return ranked.select("source", "kind", "url", "url_norm", "page_no", "pos", "priority", "fetch_rank")


def next_listing(
    pages: DataFrame, board: str, page_limit: int | None = None, link_total: int | None = None
) -> DataFrame:
    """The number of the page to ask for next: one behind the last page read, as long as
    the listing goes on. A board that ends with an empty page is done once that page is known."""
    state = paging.crawl_state(read_pages(pages, board, page_limit, link_total).select("source", "page_no", "n_links"))
    going_on = F.lit(True)
    if page_limit is not None:
        going_on = going_on & (F.col("page_no") < page_limit)
    if link_total is not None:
        going_on = going_on & (F.col("jobs_fetched") < link_total)
    if board in UNTIL_EMPTY:
        state = state.join(pages.where("n_links = 0").select("source").distinct(), "source", "left_anti")
    return state.where(going_on).select("source", (F.col("page_no") + 1).alias("page_no"), "jobs_fetched")


def retries(log: DataFrame, kind: str) -> DataFrame:
    """URLs to ask for again, within the attempts the kind of request has."""
    return quality.retry_candidates(log, ATTEMPTS[kind])
