"""Link tables: one row per link, with its place on the page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import html as H
from hirelake.functions import lists, urls


def exploded(df: DataFrame, items: str, keep: Sequence[str], value: str) -> DataFrame:
    """One row per list item with its place. The outer form, because the inner one makes
    the optimizer test the list for emptiness further down, and so extract it twice."""
    rows = df.select(*keep, F.posexplode_outer(items).alias("pos", value))
    return rows.where(F.col("pos").isNotNull())


def page_links(pages: DataFrame, html: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    """(page, n_links, pos, href) for every anchor of a page. Only the JVM touches the page;
    the count comes with the row, so no later job has to group for it."""
    found = pages.select(*keep, H.anchor_hrefs(F.col(html)).alias("_hrefs"))
    counted = found.select(*keep, F.size("_hrefs").cast("long").alias("n_links"), "_hrefs")
    return exploded(counted, "_hrefs", [*keep, "n_links"], "href")


def region_links(
    pages: DataFrame, selector: str, html: str = "html", keep: tuple = ("page_id",), start: int = 0,
    stop: int | None = None,
) -> DataFrame:
    """Links under a region. start/stop keep a slice of each page's links before the rows
    are made."""
    hrefs = H.html_values(F.col(html), selector)
    sliced_hrefs = pages.select(*keep, lists.window(hrefs, start, stop).alias("_hrefs"))
    return exploded(sliced_hrefs, "_hrefs", keep, "href")


def absolute(links: DataFrame, base: str | Column, href: str = "href") -> DataFrame:
    return links.withColumn("url", urls.absolute(F.col(href), base))


def next_link(hrefs: Column) -> Column:
    """The last pagination anchor leads to the next page."""
    return lists.at(hrefs, -1)


def cards(pages: DataFrame, card: str, fields: dict[str, str], html: str = "html",
          keep: tuple = ("page_id",)) -> DataFrame:
    """One row per card of a listing page, with the first match of each field's selector
    inside the card."""
    return card_fields(pages, card, fields, html, keep)


def card_nodes(pages: DataFrame, card: str, keep: tuple, html: str = "html") -> DataFrame:
    """One row per card with the card's own nodes in `card`."""
    read = pages.select(*keep, H.html_fields(F.col(html), {"card": card}).alias("_f"))
    inside = F.transform(F.col("_f.card"), lambda p: H.within(F.col("_f.nodes"), p))
    return exploded(read.select(*keep, inside.alias("_cards")), "_cards", keep, "card")


def card_fields(pages: DataFrame, card: str, fields: dict[str, str], html: str, keep: tuple) -> DataFrame:
    return card_nodes(pages, card, keep, html).select(
        *keep, "pos", *[H.select_first(F.col("card"), sel).alias(name) for name, sel in fields.items()]
    )


def unsponsored(cards: DataFrame, marker: str = "sponsored") -> DataFrame:
    """Drop cards that carry a sponsor mark."""
    return cards.where(F.coalesce(F.col(marker), F.lit("")) == "").drop(marker)


def link_counts(links: DataFrame, by: tuple = ("page_id",)) -> DataFrame:
    return links.groupBy(*by).agg(F.count(F.lit(1)).alias("n_links"))
