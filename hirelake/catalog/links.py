"""Link tables and listing pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.catalog import html_shapes as P
from hirelake.catalog.registry import pages as captured_pages
from hirelake.catalog.registry import query, spread_table, shape, shape_sql, table
from hirelake.catalog.sql import PAGE_LINKS, absolute_sql, host_sql, normalised_sql, origin_sql, quoted
from hirelake.functions import html as H
from hirelake.functions import urls
from hirelake.functions import text as tx
from hirelake.operators import frontier, links
from hirelake.plans import boards
from hirelake.sources import requests

REGION = "nav > ul > li *::attr(href)"
ORIGIN = "^[A-Za-z]+://[^/?#]+"


def page_frontier(spark, sf_dir):
    """Links of the captured pages as frontier rows; each page stands for a listing page."""
    rows = links.page_links(captured_pages(spark, sf_dir), keep=("page_id", "url"))
    return rows.select(
        urls.host(F.col("url")).alias("source"),
        F.col("page_id").alias("page_no"),
        F.col("pos").cast("long").alias("pos"),
        urls.absolute(F.col("href"), F.regexp_extract("url", ORIGIN, 0)).alias("url"),
    )


@query(
    f"""select source, count(*) as n_urls from (
    select distinct source, {normalised_sql('u')} as k from (
      select {host_sql('url')} as source, {absolute_sql('href', origin_sql('url'))} as u from {PAGE_LINKS} l) t) d
    group by source"""
)
def links_per_host(spark, sf_dir):
    distinct = frontier.distinct_urls(page_frontier(spark, sf_dir))
    return distinct.groupBy("source").agg(F.count(F.lit(1)).alias("n_urls"))


@query(f"select page_id, pos, href from {PAGE_LINKS} l")
def page_links(spark, sf_dir):
    rows = links.page_links(captured_pages(spark, sf_dir))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query(f"select page_id, pos, href from {PAGE_LINKS} l")
def region_links(spark, sf_dir):
    return links.region_links(captured_pages(spark, sf_dir), REGION).withColumn("pos", F.col("pos").cast("long"))


@query(f"select page_id, pos - 2 as pos, href from {PAGE_LINKS} l where pos >= 2 and pos < 5")
def link_slice(spark, sf_dir):
    rows = links.region_links(captured_pages(spark, sf_dir), REGION, start=2, stop=5)
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query(
    f"""select page_id, pos, {absolute_sql('h', origin_sql('url'))} as url from (
    select page_id, pos, url, case when url like 'https:%' and pos % 3 = 1 then '//' || {host_sql('url')} || href
      when pos % 3 = 2 then url else href end as h from {PAGE_LINKS} l) t"""
)
def absolute_links(spark, sf_dir):
    rows = links.page_links(captured_pages(spark, sf_dir), keep=("page_id", "url"))
    href = (
        F.when(F.col("url").like("https:%") & (F.col("pos") % 3 == 1),
               F.concat(F.lit("//"), urls.host(F.col("url")), F.col("href")))
        .when(F.col("pos") % 3 == 2, F.col("url"))
        .otherwise(F.col("href"))
    )
    return rows.select(
        "page_id", F.col("pos").cast("long").alias("pos"),
        urls.absolute(href, F.regexp_extract("url", ORIGIN, 0)).alias("url"),
    )


@query(f"select page_id, url, {normalised_sql('url')} as url_norm, {host_sql('url')} as host from pages")
def normalised_urls(spark, sf_dir):
    return captured_pages(spark, sf_dir).select(
        "page_id", "url", urls.normalised(F.col("url")).alias("url_norm"), urls.host(F.col("url")).alias("host")
    )


@query(
    f"""select p.page_id, l.href as next_href from pages p
    left join (select page_id, href from {PAGE_LINKS} l where pos = n_links - 1) l on p.page_id = l.page_id"""
)
def next_link(spark, sf_dir):
    return captured_pages(spark, sf_dir).select(
        "page_id", links.next_link(H.anchor_hrefs(F.col("html"))).alias("next_href")
    )


@query(f"select page_id, count(*) as n_links from {PAGE_LINKS} l group by page_id")
def link_counts(spark, sf_dir):
    return links.link_counts(links.page_links(captured_pages(spark, sf_dir)))


@query(
    """select page_no, n_links, pos, url from (
    select o_orderkey as page_no, case when o_orderstatus = 'P' then 1 else 2 end as n_links, 0 as pos,
      'https://www.monster.com.sg/job/' || cast(o_custkey as string) as url from orders
    union all
    select o_orderkey, 2, 1, 'https://www.monster.com.sg/job/' || cast(o_orderkey as string) from orders
    where o_orderstatus <> 'P') t"""
)
def sponsored_filter(spark, sf_dir):
    """Listing pages of two cards, the second sponsored for some."""
    pages = P.monster_listings(spread_table(spark, sf_dir, "orders", "o_orderkey"))
    rows = boards.listing_links(pages, "monster_sg")
    return rows.select("page_no", F.col("n_links").cast("int").alias("n_links"), "pos", "url")


@query("""select o_orderkey as page_no, o_orderkey as total from orders""")
def listing_totals(spark, sf_dir):
    pages = P.monster_listings(spread_table(spark, sf_dir, "orders", "o_orderkey"))
    return boards.listing_total(pages, "monster_sg").select("page_no", "total")


@query(
    """select source, page_no, n_links, pos, url from (
    select 'careerjet' as source, p_partkey as page_no, 2 as n_links, unnest([0, 1]) as pos,
      'https://www.careerjet.co.in/' || unnest(['job/' || p_partkey, 'company/' || p_size]) as url from part
    union all
    select 'paypal', p_partkey, 2, unnest([0, 1]),
      'https://jobsearch.paypal-corp.com/' || unnest(['en-US/job/' || p_partkey, 'en-US/job/x' || p_size]) from part
    union all
    select 'quest', p_partkey, 1, 0, 'https://careers.questdiagnostics.com/en-US/job/' || p_partkey from part
    union all
    select 'lockheed', p_partkey, 1, 0, 'https://www.lockheedmartinjobs.com/job/' || p_partkey from part
    union all
    select 'cisco', p_partkey, 12, unnest(range(12)), 'https://jobs.cisco.com/jobs/' || p_partkey || '/' || unnest(range(14, 26)) from part
    ) t"""
)
def board_listing_links(spark, sf_dir):
    """Link rules of five boards over listing pages made from `part`."""
    part = spread_table(spark, sf_dir, "part", "p_partkey")
    out = None
    for board, html in P.LISTING_HTML.items():
        pages = part.select(
            F.lit(board).alias("source"), F.col("p_partkey").alias("page_no"), F.expr(html).alias("html")
        )
        rows = boards.listing_links(pages, board).select(
            "source", "page_no", F.col("n_links").cast("int").alias("n_links"), F.col("pos").cast("long").alias("pos"), "url"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    f"""select source, unnest(range(1, last + 1)) as page_no, unnest(range(1, last + 1)) as number,
    'https://jobs.example.com/list?page=' || unnest(range(1, last + 1)) as url
    from (select source, max(page_no) as last from {shape_sql('listing_pages')} l group by source) t"""
)
def page_sequence(spark, sf_dir):
    pages = shape(spark, sf_dir, "listing_pages")
    ranges = pages.groupBy("source").agg(F.lit(1).alias("start"), F.max("page_no").alias("stop"))
    return requests.listing_requests(ranges, "https://jobs.example.com/list?page={}")


@query(
    f"""select source, unnest(range(1, cast(floor(total / 50) as bigint) + 1)) as page_no,
    unnest(range(50, total + 1, 50)) as number,
    'https://jobs.example.com/list/' || unnest(range(50, total + 1, 50)) as url
    from (select source, cast(sum(n_links) as bigint) as total from {shape_sql('listing_pages')} l group by source) t"""
)
def offset_sequence(spark, sf_dir):
    pages = shape(spark, sf_dir, "listing_pages")
    ranges = pages.groupBy("source").agg(F.lit(50).alias("start"), F.sum("n_links").alias("stop"))
    return requests.listing_requests(ranges, "https://jobs.example.com/list/{}", 50)


_PAGED = " union all ".join(
    f"select {quoted(b)} as source, {quoted(t)} as template, {a} as first, {s} as step"
    for b, (t, a, s) in requests.LISTINGS.items()
)

@query(
    f"""select source, page_no, first + (page_no - 1) * step as number,
    replace(template, '{{}}', cast(first + (page_no - 1) * step as string)) as url from (
      select p.source, p.template, cast(p.first as bigint) as first, cast(p.step as bigint) as step,
        unnest(range(1, r.last_page + 1)) as page_no
      from ({_PAGED}) p join (
        select ([{', '.join(quoted(b) for b in requests.LISTINGS)}])[1 + c_nationkey % 9] as source, count(*) as last_page
        from customer group by 1) r on p.source = r.source) t"""
)
def board_requests(spark, sf_dir):
    """Listing requests of the nine boards, as many pages as the board has customers."""
    names = F.array(*[F.lit(b) for b in requests.LISTINGS])
    counted = (
        table(spark, sf_dir, "customer")
        .groupBy(F.element_at(names, 1 + F.col("c_nationkey") % 9).alias("source"))
        .agg(F.count(F.lit(1)).alias("last_page"))
    )
    return requests.board_requests(counted)


@query(
    f"""select id, try_cast(replace(split_part(trim(heading), ' ', -1), ',', '') as bigint) as total
    from {shape_sql('badges')} t"""
)
def total_count_parse(spark, sf_dir):
    return shape(spark, sf_dir, "badges").select("id", tx.last_count(F.col("heading")).alias("total"))
