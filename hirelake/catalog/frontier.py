"""Stop rules, priority, de-duplication, domains, resume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.catalog.html_shapes import LISTING_HTML
from hirelake.catalog.links import ORIGIN
from hirelake.catalog.registry import pages as captured_pages
from hirelake.catalog.registry import query, shape, shape_sql, spread_table, table
from hirelake.catalog.sql import PAGE_LINKS, absolute_sql, host_sql, normalised_sql, origin_sql
from hirelake.functions import urls
from hirelake.operators import frontier, links, paging, quality
from hirelake.operators.seen import Seen
from hirelake.plans import boards, crawl, runs
from hirelake.plans.rules import ATTEMPTS
from hirelake.session import scratch, written
from hirelake.sources import requests
from hirelake.sources.requests import LISTINGS

LISTING = shape_sql("listing_pages")
PAGE_LIMIT = 100
ZONE = "regexp_extract({}, '([a-z]+)$', 1)"


def _zoned(spark, sf_dir):
    """Links with their top-level domain as source and their page's link count."""
    rows = links.page_links(captured_pages(spark, sf_dir), keep=("page_id", "url"))
    return rows.select(
        F.regexp_extract(urls.host(F.col("url")), "([a-z]+)$", 1).alias("source"),
        F.col("page_id").alias("page_no"),
        F.col("pos").cast("long").alias("pos"),
        "n_links",
        urls.absolute(F.col("href"), F.regexp_extract("url", ORIGIN, 0)).alias("url"),
    )


_ZONED_SQL = (
    f"(select {ZONE.format(host_sql('url'))} as source, page_id as page_no, pos, n_links, "
    f"{absolute_sql('href', origin_sql('url'))} as url from {PAGE_LINKS} l)"
)


@query(f"select source, page_no, n_links from {LISTING} l where page_no <= 20")
def stop_page_limit(spark, sf_dir):
    return paging.within_page_limit(shape(spark, sf_dir, "listing_pages"), 20)


@query(
    f"""select source, page_no, n_links, links_before from (
    select *, cast(coalesce(sum(n_links) over (partition by source order by page_no
      rows between unbounded preceding and 1 preceding), 0) as bigint) as links_before from {LISTING} l) t
    where links_before < 1200"""
)
def stop_total(spark, sf_dir):
    return paging.until_total(shape(spark, sf_dir, "listing_pages"), 1200)


@query(
    f"""select l.source, l.page_no, l.n_links from {LISTING} l left join
    (select source, min(page_no) as first from {LISTING} e where n_links = 0 group by source) f on l.source = f.source
    where f.first is null or l.page_no < f.first"""
)
def stop_first_empty(spark, sf_dir):
    return paging.until_first_empty(shape(spark, sf_dir, "listing_pages"))


@query(
    f"""select source, page_no, pos, url, priority,
    row_number() over (partition by source order by priority desc, page_no, pos, url) as fetch_rank
    from (select source, page_no, pos, url, {PAGE_LIMIT} + n_links - pos as priority from {_ZONED_SQL} z) t"""
)
def frontier_priority(spark, sf_dir):
    rows = written(frontier.detail_requests(_zoned(spark, sf_dir), PAGE_LIMIT), "requests")
    return frontier.ranked(rows).select("source", "page_no", "pos", "url", "priority", "fetch_rank")


@query(
    f"""select source, page_no, pos, url, priority,
    row_number() over (partition by source order by priority desc, page_no, pos, url) as fetch_rank
    from (select source, page_no, pos, url, page_no - pos as priority from {_ZONED_SQL} z) t"""
)
def frontier_priority_by_page(spark, sf_dir):
    rows = written(frontier.detail_requests(_zoned(spark, sf_dir), None), "requests")
    return frontier.ranked(rows).select("source", "page_no", "pos", "url", "priority", "fetch_rank")


@query(
    f"""select source, page_no, number, url, priority, {PAGE_LIMIT} - page_no + 1 as limit_priority from (
    select source, page_no, page_no as number, '/list?page=' || page_no as url, page_no - 6 as priority
    from {LISTING} l) t"""
)
def listing_priority(spark, sf_dir):
    pages = shape(spark, sf_dir, "listing_pages").select(
        "source", "page_no", F.col("page_no").alias("number"),
        F.concat(F.lit("/list?page="), F.col("page_no").cast("string")).alias("url"),
    )
    rows = frontier.listing_request_rows(pages, None).drop("kind", "pos")
    return rows.withColumn("limit_priority", frontier.listing_priority(F.col("page_no") - 1, PAGE_LIMIT))


# Pages captured over plain http stand for an earlier run.
@query(
    f"""select source, url_norm, min(page_id) as page_no from (
    select 'web' as source, {normalised_sql('url')} as url_norm, page_id from pages) t
    where url_norm not in (select {normalised_sql('url')} from pages where url like 'http:%')
    group by source, url_norm"""
)
def frontier_new_urls(spark, sf_dir):
    pages = captured_pages(spark, sf_dir)
    found = pages.select(
        F.lit("web").alias("source"), F.col("page_id").alias("page_no"), F.lit(0).alias("pos"), "url"
    )
    earlier = pages.where(F.col("url").like("http:%"))
    seen = earlier.select(F.lit("web").alias("source"), urls.normalised(F.col("url")).alias("url_norm"))
    return frontier.unseen(found, seen).select("source", "url_norm", "page_no")


@query(
    f"""select source, url_norm, page_no, pos, url from (
    select *, row_number() over (partition by source, url_norm order by page_no, pos, url) as rn from (
      select source, page_no, pos, url, {normalised_sql('url')} as url_norm from {_ZONED_SQL} z) t) r where rn = 1"""
)
def frontier_distinct(spark, sf_dir):
    rows = _zoned(spark, sf_dir).drop("n_links")
    return frontier.distinct_urls(rows)


DOMAIN_ROWS = [("web", "example.com"), ("web", "spam-farm.example.org"), ("web", "blog.example.net")]


def _domains(spark):
    return spark.createDataFrame(DOMAIN_ROWS, "source string, domain string")


_ALLOWED_SQL = " or ".join(f"h = '{d}' or ends_with(h, '.{d}')" for _, d in DOMAIN_ROWS)


@query(f"select page_id, url from (select page_id, url, {host_sql('url')} as h from pages) t where {_ALLOWED_SQL}")
def domain_filter(spark, sf_dir):
    pages = captured_pages(spark, sf_dir).select(F.lit("web").alias("source"), "page_id", "url")
    return frontier.allowed(pages, _domains(spark)).select("page_id", "url")


@query(
    f"""select l.source, l.page_no, l.n_links, s.fetched as fetched_before from {LISTING} l join (
    select b.source, max(page_no) as page_no, cast(sum(n_links) as bigint) as fetched from {LISTING} b
    join (select source, min(page_no) as first from {LISTING} e where n_links = 0 group by source) f
      on b.source = f.source and b.page_no < f.first group by b.source) s on l.source = s.source
    where l.page_no >= s.page_no
    union all
    select source, page_no, n_links, 0 from {LISTING} l
    where source not in (select source from {LISTING} e where n_links = 0)"""
)
def resume_from_state(spark, sf_dir):
    """The state is where a first run stopped, at the first empty page."""
    pages = shape(spark, sf_dir, "listing_pages")
    stopped = paging.until_first_empty(pages)
    ended = pages.where("n_links = 0").select("source").distinct()
    state = paging.crawl_state(stopped.join(ended, "source", "left_semi"))
    return paging.resume(pages, state)


@query(
    f"""select source, url_norm, page_no, pos, priority,
    row_number() over (partition by source order by priority desc, page_no, pos, url_norm) as fetch_rank from (
      select source, url_norm, page_no, pos, {PAGE_LIMIT} + n_links - pos as priority from (
        select *, row_number() over (partition by source, url_norm order by page_no, pos, n_links, url) as rn from (
          select source, page_no, pos, n_links, url, {normalised_sql('url')} as url_norm, {host_sql('url')} as h
          from {_ZONED_SQL} z) t where ends_with(h, '.example.com') or ends_with(h, '.example.net')) r
      where rn = 1 and url_norm not in (select {normalised_sql('url')} from pages)) d"""
)
def crawl_frontier(spark, sf_dir):
    """Links, allowed domains, new URLs and fetch order. The links and the new requests are
    tables, as each is read more than once."""
    zoned = _zoned(spark, sf_dir)
    domains = spark.createDataFrame([("com", "example.com"), ("net", "example.net")], "source string, domain string")
    captured = captured_pages(spark, sf_dir).select(
        F.regexp_extract(urls.host(F.col("url")), "([a-z]+)$", 1).alias("source"),
        urls.normalised(F.col("url")).alias("url_norm"),
    )
    fresh = frontier.unseen(frontier.allowed(written(zoned, "links"), domains), captured)
    rows = frontier.ranked(written(frontier.detail_requests(fresh, PAGE_LIMIT), "frontier"))
    return rows.select("source", "url_norm", "page_no", "pos", "priority", "fetch_rank")


@query(
    """select 'quest' as source, 'https://careers.questdiagnostics.com/en-US/job/' || p_partkey as url, p_partkey as page_no,
    0 as pos, p_partkey as priority, row_number() over (order by p_partkey desc) as fetch_rank
    from part"""
)
def board_frontier(spark, sf_dir):
    """All listing pages of one board, made from `part`, to its ranked detail requests."""
    listings = spread_table(spark, sf_dir, "part", "p_partkey").select(
        F.lit("quest").alias("source"), F.col("p_partkey").alias("page_no"), F.expr(LISTING_HTML["quest"]).alias("html")
    )
    none = spark.createDataFrame([], "source string, url_norm string")
    ranked = crawl.detail_frontier(listings, none, "quest")
    return ranked.select("source", "url", "page_no", "pos", "priority", "fetch_rank")


@query(f"select source, max(page_no) + 1 as page_no, cast(sum(n_links) as bigint) as jobs_fetched from {LISTING} l group by source")
def next_listing(spark, sf_dir):
    """The page to ask for next of boards whose listing has no end of its own."""
    return crawl.next_listing(shape(spark, sf_dir, "listing_pages"), "paypal")


BOARD_ROWS = ", ".join(
    f"('{b}', {str(b in ('riteaid', 'cisco', 'marriott')).lower()})"
    for b in ("careerjet", "cisco", "lockheed", "marriott", "mckesson", "monster_sg", "paypal", "quest", "riteaid")
)


@query(
    f"""select board, l.source, max(page_no) + 1 as page_no, cast(sum(n_links) as bigint) as jobs_fetched
    from {LISTING} l cross join (values {BOARD_ROWS}) b(board, until_empty) left join
      (select source as ended from {LISTING} e where n_links = 0 group by source) e on l.source = e.ended
    where not until_empty or ended is null group by board, l.source"""
)
def next_listing_boards(spark, sf_dir):
    """The page to ask for next under the stop rule of each of the nine boards."""
    pages, out = shape(spark, sf_dir, "listing_pages"), None
    for board in LISTINGS:
        one = crawl.next_listing(pages, board).select(F.lit(board).alias("board"), "source", "page_no", "jobs_fetched")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """select url, page_no, pos, priority, row_number() over (order by priority desc, page_no, pos, url) as fetch_rank from (
    select 'https://mckesson.wd3.myworkdayjobs.com/job/' || n as url, min(page_no) as page_no, arg_min(pos, page_no) as pos,
      20 - arg_min(pos, page_no) as priority from (
        select event_id as page_no, 0 as pos, event_id as n from events union all select event_id, 1, event_id + 1 from events) t
    group by n) d"""
)
def api_frontier(spark, sf_dir):
    """Listing responses of a board that pages by JSON to its ranked detail requests."""
    bodies = shape(spark, sf_dir, "paging_api").select(F.lit("mckesson").alias("source"), F.col("id").alias("page_no"), "body")
    none = spark.createDataFrame([], "source string, url_norm string")
    ranked = crawl.detail_frontier(bodies, none, "mckesson")
    return ranked.select("url", "page_no", F.col("pos").cast("int").alias("pos"), F.col("priority").cast("int").alias("priority"), "fetch_rank")


def stored_seen(spark, buckets: int = 64) -> Seen:
    """An empty table of requested URLs."""
    path = scratch(spark, "seen")
    return Seen(spark, "seen_" + path[-32:], path, buckets)


# The URLs captured over plain http were requested by an earlier run, the others by the first of two.
@query(
    f"""select run, source, url_norm, page_no from (
    select 1 as run, 'web' as source, url_norm, min(page_id) as page_no from (
      select {normalised_sql('url')} as url_norm, page_id from pages) t
    where url_norm not in (select {normalised_sql('url')} from pages where url like 'http:%') group by url_norm
    union all
    select 2, 'web', 'http://new.example.com/p/' || page_id, page_id from pages where page_id % 3 = 0) u"""
)
def frontier_runs(spark, sf_dir):
    """Two runs of a crawl with the table of requested URLs between them: the second asks for the
    first one's URLs too, and gets none of them."""
    seen = stored_seen(spark)
    pages = captured_pages(spark, sf_dir)
    found = pages.select(F.lit("web").alias("source"), F.col("page_id").alias("page_no"), F.lit(0).alias("pos"), "url")
    seen.remember(found.where(F.col("url").like("http:%")).withColumn("url_norm", urls.normalised(F.col("url"))))
    first = written(seen.unseen(found), "run-1")
    seen.remember(first)
    again = found.where("page_no % 3 = 0").withColumn("url", F.concat(F.lit("http://new.example.com/p/"), F.col("page_no").cast("string")))
    second = written(seen.unseen(found.unionByName(again)), "run-2")
    seen.remember(second)
    rows = lambda run, df: df.select(F.lit(run).alias("run"), "source", "url_norm", "page_no")
    return rows(1, first).unionByName(rows(2, second))


@query(
    """select kind, url, page_no, pos, priority, row_number() over (order by priority desc, page_no, pos, url) as fetch_rank from (
    select 'detail' as kind, 'https://careers.questdiagnostics.com/en-US/job/' || p_partkey as url, p_partkey as page_no,
      0 as pos, p_partkey as priority from part
    union all
    select 'listing', 'https://careers.questdiagnostics.com/en-US/search?keywords=&location=&pagenumber=' || (max(p_partkey) + 1),
      max(p_partkey) + 1, -1, max(p_partkey) - 5 from part) t"""
)
def board_requests_ranked(spark, sf_dir):
    """Detail requests of a board's listing pages and the request for its next page, in one order."""
    listings = spread_table(spark, sf_dir, "part", "p_partkey").select(
        F.lit("quest").alias("source"), F.col("p_partkey").alias("page_no"), F.expr(LISTING_HTML["quest"]).alias("html")
    )
    ranked = crawl.all_requests(listings, stored_seen(spark), "quest")
    return ranked.select("kind", "url", "page_no", F.col("pos").cast("int").alias("pos"), "priority", "fetch_rank")


@query(
    """select p_partkey as page_no, case when p_partkey % 4 > 0 then 'https://www.careerjet.co.in/jobs?p=' || (p_partkey + 1) end as next_url
    from part"""
)
def careerjet_next_page(spark, sf_dir):
    """The last link of a listing page's own pagination; every fourth page has none."""
    links_ = (
        "case when p_partkey % 4 > 0 then concat('<p><a href=\"/jobs?p=', p_partkey - 1, '\">back</a>"
        "<a href=\"/jobs?p=', p_partkey + 1, '\">next</a></p>') else '' end"
    )
    html = f"concat('<div id=\"search-content\"><ul class=\"jobs\"><li><a href=\"/j/1\">J</a></ul>', {links_}, '</div><a href=\"/no\">n</a>')"
    listings = spread_table(spark, sf_dir, "part", "p_partkey").select(
        F.lit("careerjet").alias("source"), F.col("p_partkey").alias("page_no"), F.expr(html).alias("html")
    )
    return boards.next_page(listings, "careerjet").select("page_no", "next_url")


_FAILURE = """case event_type when 'error' then 'http' when 'signup' then 'dns' when 'purchase' then 'timeout'
    when 'view' then 'unknown' else 'ok' end"""


@query(
    " union all ".join(
        f"""select '{kind}' as kind, url, attempts, last_failure from (
        select 'https://jobs.example.com/j/' || user_id || '/' || event_id % 9 as url, count(*) as attempts,
          arg_max({_FAILURE}, (ts, event_id)) as last_failure from events group by 1) t
        where last_failure <> 'ok' and attempts < {most}"""
        for kind, most in ATTEMPTS.items()
    )
)
def retries_by_kind(spark, sf_dir):
    """What to ask for again, with the attempts that each kind of request has."""
    log = shape(spark, sf_dir, "fetch_log").select(
        F.concat("url", F.lit("/"), (F.col("event_id") % 9).cast("string")).alias("url"), "ts", "event_id",
        quality.failure_class(F.col("status"), F.col("error")).alias("failure"),
    )
    return quality.retries_by_kind(log, ATTEMPTS)


# A run captures each listing from its first page to a third, two thirds and the whole of it.
_THIRD = "(select source, max(page_no) as m from {} t group by source)"
RUNS_SQL = f"""select board, run, l.source, coalesce(max(page_no) filter (where inside), 0) as page_no,
    cast(coalesce(sum(n_links) filter (where inside), 0) as bigint) as jobs_fetched, not bool_and(inside) as ended
    from (select board, run, l.source, page_no, n_links, board = 'paypal' or coalesce(page_no < first, true) as inside
      from {LISTING} l join {_THIRD.format(LISTING)} s on l.source = s.source
      left join (select source, min(page_no) as first from {LISTING} e where n_links = 0 group by source) f on l.source = f.source
      cross join (values ('paypal'), ('riteaid')) b(board) cross join (values (1), (2), (3)) r(run)
      where page_no <= m * run // 3) l group by board, run, l.source"""


@query(RUNS_SQL)
def saved_state_runs(spark, sf_dir):
    """Three runs of a crawl that go on from the saved state, of a board that ends at an empty page and
    of one that does not. Pages of earlier runs are captured again and do not count twice."""
    pages = written(shape(spark, sf_dir, "listing_pages"), "listing-pages")
    thirds = pages.groupBy("source").agg(F.max("page_no").alias("m"))
    out = []
    for board in ("paypal", "riteaid"):
        crawl_ = runs.Runs(spark, scratch(spark, f"{board}-runs"), board)
        for run in (1, 2, 3):
            captured = pages.join(thirds, "source").where(F.col("page_no") * 3 <= F.col("m") * run).drop("m")
            state = crawl_.finish(captured, run)
            out.append(state.select(F.lit(board).alias("board"), F.lit(run).alias("run"), "*"))
    return reduce(DataFrame.unionByName, out)


_TERMS = "select case p_partkey % 3 when 0 then 'monster_sg' when 1 then 'paypal' else 'quest' end as source, p_type as query"


@query(
    f"""select source, query, page_no, number, case source
      when 'monster_sg' then 'https://www.monster.com.sg/srp/results?start=' || number || '&sort=1&limit=18&query=' || url_encode(query)
      when 'paypal' then 'https://jobsearch.paypal-corp.com/en-US/search?keywords=' || url_encode(query) ||
        '&facetcountry=&location=&facetcategory=&pagenumber=' || number
      else 'https://careers.questdiagnostics.com/en-US/search?keywords=' || url_encode(query) || '&location=&pagenumber=' || number end as url
    from (select *, case source when 'monster_sg' then (page_no - 1) * 18 else page_no end as number from (
      select source, query, unnest(generate_series(1, last_page)) as page_no
      from (select source, query, count(*) as last_page from ({_TERMS} from part) t group by source, query) c) p) n"""
)
def search_requests(spark, sf_dir):
    """The listing requests of each search term, as many pages as the term has parts."""
    terms = spark.sql(
        f"select source, query, count(*) as last_page from ({_TERMS} from {{part}}) t group by source, query",
        part=table(spark, sf_dir, "part"),
    )
    return requests.search_requests(terms)
