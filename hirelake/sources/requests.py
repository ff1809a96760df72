"""Listing requests: a URL template over a number range, one row per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How each board's listing is paged. `{}` takes the page number or offset.
LISTINGS = {
    "marriott": ("https://jobs.marriott.com/api/jobs?page={}&sortBy=relevance&descending=false&internal=false", 1, 1),
    "paypal": (
        "https://jobsearch.paypal-corp.com/en-US/search?keywords=&facetcountry=&location=&facetcategory=&pagenumber={}",
        1, 1,
    ),
    "quest": ("https://careers.questdiagnostics.com/en-US/search?keywords=&location=&pagenumber={}", 1, 1),
    "lockheed": ("https://www.lockheedmartinjobs.com/search-jobs?p={}", 1, 1),
    "careerjet": ("https://www.careerjet.co.in/jobs-in-india-83624.html?p={}", 1, 1),
    "riteaid": ("https://careers.riteaid.com/jobs?page={}", 1, 1),
    "monster_sg": ("https://www.monster.com.sg/srp/results?start={}&sort=1&limit=18&query=Data%20scientist", 0, 18),
    "cisco": (
        "https://jobs.cisco.com/jobs/SearchJobs/?source=Cisco+Jobs+Career+Site"
        "&tags=CDC+Browse+all+jobs+careers&projectOffset={}",
        0, 25,
    ),
    "mckesson": (
        "https://mckesson.wd3.myworkdayjobs.com/Global/fs/searchPagination/318c8bb6f553100021d223d9780d30be/{}",
        50, 50,
    ),
}

# The parameter of a listing that takes a search term.
SEARCH = {"monster_sg": "query", "paypal": "keywords", "quest": "keywords"}

BLOCK = 10_000


def listing_requests(ranges: DataFrame, template: str | Column, step: int | Column = 1) -> DataFrame:
    """One request per number start, start + step, ... up to stop, from one row per crawl
    with `start` and `stop`. Rows multiply on the executors and in two steps, blocks first,
    which are dealt by crawl and block: neither the requests of a large crawl nor those of very
    many small ones end up in one list or task."""
    text = F.lit(template) if isinstance(template, str) else template
    by = (F.lit(step) if isinstance(step, int) else step).cast("long")
    keep = [c for c in ranges.columns if c not in ("start", "stop")]
    counted = (
        ranges.where(F.col("stop") >= F.col("start"))
        .withColumn("_template", text)
        .withColumn("_step", by)
        .withColumn("_n", F.floor((F.col("stop") - F.col("start")) / F.col("_step")).cast("long") + 1)
    )
    block = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BLOCK).cast("long"))
    blocks = counted.withColumn("_first", F.explode(block)).repartition(*keep, "start", "stop", "_first")
    last = F.least(F.col("_first") + BLOCK, F.col("_n")) - 1
    return (
        blocks.withColumn("_i", F.explode(F.sequence("_first", last)))
        .withColumn("page_no", F.col("_i") + 1)
        .withColumn("number", (F.col("start") + F.col("_i") * F.col("_step")).cast("long"))
        .withColumn("url", F.replace("_template", F.lit("{}"), F.col("number").cast("string")))
        .select(*keep, "page_no", "number", "url")
    )


def _paged(ranges: DataFrame, keep: list[str]) -> DataFrame:
    """Each board's first and last number, with its paging in `_p`; other sources have no rows."""
    rows = [
        F.struct(F.lit(name).alias("source"), F.lit(template).alias("template"), F.lit(SEARCH.get(name)).alias("term"),
                 F.lit(first).cast("long").alias("first"), F.lit(step).cast("long").alias("step"))
        for name, (template, first, step) in LISTINGS.items()
    ]
    paging = F.try_element_at(F.filter(F.array(*rows), lambda r: r["source"] == F.col("source")), F.lit(1))
    return (
        ranges.select(*keep, "last_page", paging.alias("_p"))
        .where(F.col("_p").isNotNull())
        .withColumn("start", F.col("_p.first"))
        .withColumn("stop", F.col("_p.first") + (F.col("last_page") - 1) * F.col("_p.step"))
    )


def board_requests(ranges: DataFrame) -> DataFrame:
    """Requests for rows `(source, last_page)`, each board paged its own way."""
    made = listing_requests(_paged(ranges, ["source"]), F.col("_p.template"), F.col("_p.step"))
    return made.select("source", "page_no", "number", "url")


def search_requests(ranges: DataFrame) -> DataFrame:
    """Requests for rows `(source, query, last_page)`: the same term on every page of a listing. A
    null term leaves the board's own; a board whose listing takes no term has no requests for one."""
    known = _paged(ranges, ["source", "query"]).where(F.col("query").isNull() | F.col("_p.term").isNotNull())
    encoded = F.replace(F.url_encode("query"), F.lit("+"), F.lit("%20"))
    place = F.concat(F.lit("(?<=[?&]"), F.col("_p.term"), F.lit("=)[^&]*"))
    template = F.coalesce(F.regexp_replace(F.col("_p.template"), place, encoded), F.col("_p.template"))
    made = listing_requests(known, template, F.col("_p.step"))
    return made.select("source", "query", "page_no", "number", "url")
