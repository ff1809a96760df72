"""Detail pages of each board to postings.

Every function takes captured pages `(url, html, captured_at)` of one board and returns
canonical columns (those the board fills). The page is parsed once, in one Arrow UDF;
all else is built-in expressions, so a query on three columns of the result evaluates
three columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import dates, lists, pay, urls
from hirelake.functions import html as H
from hirelake.functions import text as tx
from hirelake.operators import cards as card_ops
from hirelake.operators import links as link_ops
from hirelake.plans import schema
from hirelake.plans.rules import (
    DESCRIPTION_CUTS,
    LINK_BASES,
    LINK_SLICES,
    LISTING_RULES,
    MIN_DESCRIPTION,
    POSITIONS,
    RULES,
)
from hirelake.sources import json_api

KEEP = ("url", "captured_at")
OFFSET_STAMP = "yyyy-MM-dd'T'HH:mm:ssZ"
# Rules that apply inside a detail row, not to the page.
INNER = {"detail_key", "detail_value"}


def _nodes(pages: DataFrame, rules: dict[str, str], keep: tuple = KEEP) -> DataFrame:
    outer = {name: sel for name, sel in rules.items() if name not in INNER}
    return pages.select(*keep, H.html_fields(F.col("html"), outer).alias("f"))


def _all(rule: str) -> Column:
    """All that a rule matches on the page: values, or places of elements in `f.nodes`."""
    return F.col("f")[rule]


def _first(rule: str) -> Column:
    return F.get(_all(rule), F.lit(0))


def _seen(rule: str) -> Column:
    """Visible text of the first element a rule matches."""
    return H.visible_text(H.within_first(_all("nodes"), _all(rule)))


def _fields(df: DataFrame, board: str, **columns: Column) -> DataFrame:
    constant = schema.CONSTANTS[board]
    columns = {"source": F.lit(board), **columns}
    if "EmployerName" in constant:
        columns["employer_name"] = F.lit(constant["EmployerName"])
    if "Currency" in constant:
        columns["currency"] = F.lit(constant["Currency"])
    return df.select(*[c.alias(name) for name, c in columns.items()], "captured_at")


def _one(text: Column) -> Column:
    return F.when(text.isNotNull(), F.array(text))


def monster_sg(pages: DataFrame) -> DataFrame:
    board, rules = "monster_sg", RULES["monster_sg"]
    details = F.transform(
        _all("detail"),
        lambda place: lists.let(
            H.within(_all("nodes"), place),
            lambda row: F.struct(
                H.select_first(row, rules["detail_key"]).alias("key"),
                H.select_all(row, rules["detail_value"]).alias("value"),
            ),
        ),
    )
    df = _nodes(pages, rules).withColumn("details", details)
    routed = lambda word: lists.routed(F.col("details"), word)
    one = lambda word: lists.at(routed(word), 0)
    salary_raw = tx.clean(_first("salary"), board)
    employment_type = tx.clean(_first("employment_type"), board)
    posted = F.coalesce(one("Posted"), _first("posted"))
    job_id = tx.integer_after_colon(F.coalesce(_first("badge_4"), _first("badge_3")))
    return _fields(
        df,
        board,
        employer_name=tx.clean(_first("employer"), board),
        job_id=job_id.cast("string"),
        title=tx.clean(_first("title"), board),
        location=F.coalesce(
            one("Location"), tx.clean(_first("location"), board), F.lit(schema.CONSTANTS[board]["Location"])
        ),
        employment_type=employment_type,
        employment_industry=_one(tx.clean(one("Industry"), board)),
        job_function=_one(F.when(F.size("details") > 0, F.coalesce(one("Function"), F.lit("IT")))),
        skills=lists.clean_skills(routed("Skills")),
        experience=pay.experience_range(_first("experience")),
        experience_raw=tx.clean(_first("experience"), board),
        salary=pay.salary_for_type(pay.salary_range(tx.sentinel_to_null(salary_raw)), employment_type),
        salary_raw=pay.salary_text_for_type(salary_raw, employment_type),
        posted_raw=posted,
        posted_at=dates.posted_at(posted, F.col("captured_at")),
        description=lists.first_filled(*[_all(f"description_{i}") for i in range(1, 6)]),
        apply_url=F.col("url"),
    )


def careerjet(pages: DataFrame) -> DataFrame:
    board, rules = "careerjet", RULES["careerjet"]
    n = _all("nodes")

    def outside_icon(place: Column) -> Column:
        shown = F.filter(H.outside(H.within(n, place), "svg"), lambda x: x["text"].isNotNull())
        return tx.stripped(F.array_join(F.transform(shown, lambda x: x["text"]), ""))

    header = F.transform(_all("detail"), outside_icon)
    # Columns of their own, as what is made of them names them several times.
    found = {"header": header, "posted": _first("posted"), "text": H.plain_text(H.within_first(n, _all("description")))}
    df = _nodes(pages, rules).withColumns(found).withColumn("layout", lists.layout(F.col("header")))
    posted, description = F.col("posted"), F.col("text")
    return _fields(
        df,
        board,
        employer_name=tx.stripped(_first("employer")),
        title=_first("title"),
        location=F.col("layout.location"),
        employment_type=F.col("layout.employment_type"),
        salary=pay.salary_range(F.col("layout.salary")),
        salary_raw=F.col("layout.salary"),
        posted_raw=posted,
        posted_at=dates.posted_at(posted, F.col("captured_at")),
        description=tx.clean(tx.without_ends(description), board),
        job_url=F.col("url"),
        apply_url=urls.absolute(_first("apply"), LINK_BASES[board]),
    )


def paypal(pages: DataFrame, date_format: str = "M/d/y") -> DataFrame:
    board = "paypal"
    df = _nodes(pages, RULES[board]).withColumn("block", _all("block"))
    field = {k: tx.non_empty(lists.at(F.col("block"), i)) for k, i in POSITIONS[board].items()}
    parts = lists.between(_all("description"), *DESCRIPTION_CUTS[board])
    cleaned = F.transform(parts, lambda x: H.unescaped(tx.without_tags(tx.clean(x, board))))
    return _fields(
        df,
        board,
        job_id=field["job_id"],
        title=tx.stripped(_first("title")),
        location=field["location"],
        employment_type=field["employment_type"],
        employment_industry=_one(field["industry"]),
        experience=pay.experience_range(field["experience"]),
        experience_raw=tx.sentinel_to_null(field["experience"]),
        posted_raw=field["posted"],
        posted_date=dates.typed_date(field["posted"], date_format),
        description=lists.joined(cleaned),
        job_url=F.col("url"),
    )


def quest(pages: DataFrame, date_format: str = "M/d/y") -> DataFrame:
    board = "quest"
    df = _nodes(pages, RULES[board]).withColumn("snapshot", _all("snapshot"))
    at = {k: lists.at(F.col("snapshot"), i) for k, i in POSITIONS[board].items()}
    location = _first("location")
    cleaned = F.transform(_all("description"), lambda x: tx.clean(x, board))
    return _fields(
        df,
        board,
        job_id=at["job_id"],
        title=tx.title_before(_first("title"), location),
        location=location,
        employment_type=at["employment_type"],
        employment_industry=_one(_first("industry")),
        posted_raw=at["posted"],
        posted_date=dates.typed_date(at["posted"], date_format),
        description=lists.joined(lists.between(cleaned, *DESCRIPTION_CUTS[board])),
        job_url=F.col("url"),
    )


def lockheed(pages: DataFrame, date_format: str = "M/d/y") -> DataFrame:
    board = "lockheed"
    df = _nodes(pages, RULES[board])
    industry = _all("industry")
    posted = lists.at(_all("posted"), -1)
    parts = lists.between(_all("description"), *DESCRIPTION_CUTS[board])
    return _fields(
        df,
        board,
        job_id=lists.at(_all("job_id"), -1),
        title=_first("title"),
        location=_first("location"),
        employment_industry=F.when(F.size(industry) > 0, industry),
        posted_raw=posted,
        posted_date=dates.typed_date(posted, date_format),
        description=lists.joined(F.transform(parts, tx.without_crlf)),
        apply_url=_first("apply"),
    )


def cisco(pages: DataFrame) -> DataFrame:
    board = "cisco"
    return _fields(
        _nodes(pages, RULES[board]),
        board,
        job_id=_seen("job_id"),
        title=_seen("title"),
        location=_seen("location"),
        employment_industry=_one(_seen("industry")),
        description=_seen("description"),
        job_url=F.col("url"),
    )


def mckesson(pages: DataFrame) -> DataFrame:
    board = "mckesson"
    shown = F.transform(_all("item"), lambda place: H.visible_text(H.within(_all("nodes"), place)))
    items = lists.distinct_core(shown)
    df = _nodes(pages, RULES[board]).withColumn("items", items)
    at = {k: lists.at(F.col("items"), i) for k, i in POSITIONS[board].items()}
    return _fields(
        df,
        board,
        job_id=at["job_id"],
        title=at["title"],
        location=at["location"],
        employment_type=at["employment_type"],
        posted_raw=at["posted"],
        posted_at=dates.posted_at(at["posted"], F.col("captured_at")),
        description=tx.without_chars(lists.first_of_length(F.col("items"), MIN_DESCRIPTION), "\n"),
        job_url=F.col("url"),
    )


def marriott(captures: DataFrame) -> DataFrame:
    """From the job API: captures `(body, captured_at)`."""
    board = "marriott"
    job = F.col("job")
    parsed = json_api.jobs(captures.select("body", "captured_at"))
    return _fields(
        parsed,
        board,
        job_id=job["slug"],
        title=job["title"],
        location=json_api.location(job),
        employment_type=job["employment_type"],
        employment_industry=_one(job["industry"]),
        job_function=json_api.categories(job),
        experience=pay.experience_range(job["experience_levels"]),
        experience_raw=job["experience_levels"],
        posted_raw=job["create_date"],
        posted_at=F.coalesce(
            F.try_to_timestamp(job["create_date"]), F.try_to_timestamp(job["create_date"], F.lit(OFFSET_STAMP))
        ),
        description=tx.clean(H.html_text(job["description"]), board),
        job_url=urls.slug_url(job["slug"], LINK_BASES[board]),
        apply_url=job["apply_url"],
    )


def riteaid_cards(listings: DataFrame) -> DataFrame:
    """Cards of listing pages: url of the posting, industry, label. The link and its label
    are those of the card's first anchor."""
    rules = LISTING_RULES["riteaid"]
    card = F.col("card")
    return (
        link_ops.card_nodes(listings, rules["card"], ())
        .select(
            H.visible_text(H.first_within(card, rules["industry"])).alias("industry"),
            H.first_element(card, rules["anchor"])["attrs"].alias("a"),
        )
        .select(
            urls.absolute(F.try_element_at("a", F.lit("href")), LINK_BASES["riteaid"]).alias("job_url"),
            "industry",
            F.try_element_at("a", F.lit("aria-label")).alias("label"),
        )
    )


def riteaid_details(pages: DataFrame) -> DataFrame:
    return _nodes(pages, RULES["riteaid"]).select(
        F.col("url").alias("job_url"),
        _seen("location").alias("location"),
        _seen("description").alias("description"),
        _first("apply").alias("apply_url"),
        "captured_at",
    )


def riteaid_judged(listings: DataFrame, details: DataFrame) -> DataFrame:
    """All listing cards joined with detail pages, with what each one lacks."""
    return card_ops.joined(riteaid_cards(listings), card_ops.latest_details(riteaid_details(details)))


def riteaid(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Listing cards joined with detail pages; a posting with a missing part is left out."""
    return riteaid_fields(card_ops.quality.accepted(riteaid_judged(listings, details)))


def riteaid_fields(found: DataFrame, **more: Column) -> DataFrame:
    """Canonical columns of joined cards, and further ones."""
    return _fields(
        found,
        "riteaid",
        **more,
        job_id=F.col("job_id"),
        title=F.col("title"),
        location=F.col("location"),
        employment_industry=_one(F.col("industry")),
        description=F.col("description"),
        job_url=F.col("job_url"),
        apply_url=F.col("apply_url"),
    )


BOARDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "monster_sg": monster_sg,
    "careerjet": careerjet,
    "paypal": paypal,
    "quest": quest,
    "lockheed": lockheed,
    "cisco": cisco,
    "mckesson": mckesson,
}


def listing_pages(listings: DataFrame, board: str) -> DataFrame:
    """`(source, page_no, n_links, hrefs)` of listing pages; a page without links counts 0, one
    without HTML null."""
    rules = LISTING_RULES[board]
    f = F.col("f")
    if "card" in rules:
        cards = F.transform(f["outer"], lambda place: H.within(f["nodes"], place))
        if "sponsored" in rules:
            cards = F.filter(cards, lambda c: F.coalesce(H.select_first(c, rules["sponsored"]), F.lit("")) == "")
        hrefs = F.array_compact(F.transform(cards, lambda c: H.select_first(c, rules["link"])))
        outer = rules["card"]
    else:
        hrefs = lists.window(f["outer"], *LINK_SLICES.get(board, (0, None)))
        outer = rules["links"]
    read = F.col("html").isNotNull().alias("read")
    return (
        listings.select("source", "page_no", read, H.html_fields(F.col("html"), {"outer": outer}).alias("f"))
        .select("source", "page_no", "read", hrefs.alias("hrefs"))
        .select("source", "page_no", F.when(F.col("read"), F.size("hrefs")).cast("long").alias("n_links"), "hrefs")
    )


def next_page(listings: DataFrame, board: str) -> DataFrame:
    """The link to the next listing page, the last one of the page's own links to pages; null where
    there is none."""
    rule = LISTING_RULES[board]["next"]
    href = link_ops.next_link(H.html_values(F.col("html"), rule))
    return listings.select("source", "page_no", urls.absolute(href, LINK_BASES[board]).alias("next_url"))


#: Boards whose listing is an API; each gives its links as a list.
API_PAGES: dict[str, Callable[[], Column]] = {"mckesson": json_api.nested_hrefs, "marriott": json_api.slugs}


def api_pages(captures: DataFrame, board: str) -> DataFrame:
    """The same as listing_pages, of API responses `(source, page_no, body)`; an unreadable one
    has a null count."""
    hrefs = API_PAGES[board]()
    return captures.select("source", "page_no", hrefs.alias("hrefs")).select(
        "source", "page_no", F.when(F.col("hrefs").isNotNull(), F.size("hrefs")).cast("long").alias("n_links"), "hrefs"
    )


def page_links(pages: DataFrame, board: str) -> DataFrame:
    """One row per link of listing_pages: position, href, absolute url."""
    rows = link_ops.exploded(pages, "hrefs", ["source", "page_no", "n_links"], "href")
    return rows.withColumn("url", urls.absolute(F.col("href"), LINK_BASES[board]))


def listing_links(listings: DataFrame, board: str) -> DataFrame:
    """Detail links of listing pages `(source, page_no, html)`."""
    return page_links(listing_pages(listings, board), board)


def listing_total(listings: DataFrame, board: str = "monster_sg") -> DataFrame:
    """The total a listing page's heading gives."""
    rule = LISTING_RULES[board]["total"]
    heading = F.get(H.html_values(F.col("html"), rule), F.lit(0))
    return listings.select("source", "page_no", tx.last_count(heading).alias("total"))
