"""Streaming queries, drained with availableNow and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.catalog.registry import query, shape, shape_sql, table
from hirelake.catalog.sql import host_sql, normalised_sql
from hirelake.functions import html as H
from hirelake.functions import urls
from hirelake.operators import quality
from hirelake.session import scratch
from hirelake.sources import captures
from hirelake.streaming import incremental, metrics, stateful


def _arriving(spark, sf_dir):
    """The given pages as a stream, one file or a folder of them; captured_at counts up with the page."""
    # A pattern, as a stream takes a path without one for a folder.
    pages = captures.page_stream(spark, f"{sf_dir}/pages.parque[t]", captures.PAGES)
    return pages.select(
        F.lit("web").alias("source"), "page_id", "url", "html",
        F.timestamp_add("SECOND", F.col("page_id"), F.expr("timestamp '2024-01-01 00:00:00'")).alias("captured_at"),
    )


def _fields(pages):
    rules = {"title": "title::text", "links": "nav > ul > li > a::attr(href)"}
    read = pages.select("source", "page_id", "url", H.html_fields(F.col("html"), rules).alias("f"))
    return read.select(
        "source", "page_id", "url", F.get(F.col("f.title"), F.lit(0)).alias("title"), F.size("f.links").alias("n_links")
    )


_TITLE = "replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;', '\"'), '&amp;', '&')"
_LINKS = "cast(len(regexp_extract_all(html, '<li><a href')) as integer)"


@query(f"select 'web' as source, page_id, url, {_TITLE} as title, {_LINKS} as n_links from pages")
def stream_postings(spark, sf_dir):
    """Extraction on each arriving page."""
    path = scratch(spark, "stream-postings")
    rows = incremental.postings(_arriving(spark, sf_dir), _fields)
    incremental.start(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows")


@query(f"select distinct {normalised_sql('url')} as url_norm from pages")
def stream_first_seen(spark, sf_dir):
    """Each URL once; the second run over the same files adds nothing."""
    path = scratch(spark, "stream-first-seen")
    for _ in range(2):
        rows = incremental.first_seen(_arriving(spark, sf_dir).select("source", "url"))
        incremental.start(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("url_norm")


@query(f"select distinct {normalised_sql('url')} as url_norm from pages")
def stream_first_seen_within(spark, sf_dir):
    path = scratch(spark, "stream-within")
    rows = incremental.first_seen_within(_arriving(spark, sf_dir).select("source", "url", "captured_at"), "30 days")
    incremental.start(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("url_norm")


@query(f"select {host_sql('url')} as source, count(*) as n from pages group by 1")
def stream_counts(spark, sf_dir):
    path = scratch(spark, "stream-counts")
    pages = _arriving(spark, sf_dir).select(urls.host(F.col("url")).alias("source"))
    incremental.start_counts(incremental.counts(pages), f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return incremental.latest_counts(spark, f"{path}/rows")


@query(
    """select cast(count(*) as bigint) as pages,
    cast(sum(len(html)) as bigint) as chars, cast(count(*) filter (where url like 'https:%') as bigint) as secure from pages"""
)
def stream_metrics(spark, sf_dir):
    """What the batches of a stream report as they pass, summed up from the table of reports."""
    path = scratch(spark, "stream-metrics")
    secure = F.count_if(F.col("url").like("https:%"))
    rows = metrics.observed(
        _arriving(spark, sf_dir), "responses", pages=F.count(F.lit(1)), chars=F.sum(F.length("html")), secure=secure
    ).select("source", "url")
    with metrics.MetricsTable(spark, f"{path}/metrics") as table:
        table.wait(incremental.start(rows, f"{path}/rows", f"{path}/checkpoint"))
    values = metrics.latest(table.rows().where("observation = 'responses'")).groupBy().pivot("metric", ["pages", "chars", "secure"])
    return values.agg(F.sum("value").cast("long"))


@query(
    f"""with k as (select page_id, {normalised_sql('url')} as url_norm, max(page_id) over () as m from pages),
    f as (select *, min(page_id) over (partition by url_norm) as f from k)
    select url_norm, page_id, 'first' as outcome from f where page_id = f
    union all select url_norm, page_id, case when page_id = m then 'first' else 'late' end from f where 2 * f + 19 <= 2 * m"""
)
def stream_seen_late(spark, sf_dir):
    """Pages a day apart that arrive twice, remembered for nine and a half days: whatever comes
    again after its page has left the state is late."""
    path = scratch(spark, "stream-seen-late")
    day = F.timestamp_add("DAY", F.col("page_id"), F.expr("timestamp '2024-01-01 00:00:00'"))
    pages = table(spark, sf_dir, "pages").select(F.lit("web").alias("source"), "page_id", "url", day.alias("captured_at"))
    for _ in range(2):
        pages.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(pages.schema).parquet(f"{path}/in")
        rows = stateful.seen_within(stream, "0 seconds", 19 * 43_200_000)
        incremental.start(rows, f"{path}/rows", f"{path}/checkpoint", ("outcome",)).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("url_norm", "page_id", "outcome")


_FAILURE = """case event_type when 'error' then 'http' when 'signup' then 'dns' when 'purchase' then 'timeout'
    when 'view' then 'unknown' else 'ok' end"""


@query(
    f"""with l as (select 'https://jobs.example.com/j/' || user_id || '/' || event_id % 9 as url, epoch_us(ts) // 1000 as ms, event_id,
      {_FAILURE} as failure from events),
    o as (select *, row_number() over w as n, lead(ms) over w as following, max(ms) over () as m
      from l window w as (partition by url order by ms, event_id)),
    d as (select *, ms + 10800000 * (1 << cast(least(n - 1, 10) as integer)) as due_ms from o)
    select url, due_ms, n as attempts, failure as last_failure from d
    where failure <> 'ok' and n < 5 and (following is null or following > due_ms) and due_ms <= m - 86400000"""
)
def stream_retry_times(spark, sf_dir):
    """When each URL is to be asked for again, by timers of the log's own time."""
    path = scratch(spark, "stream-retries")
    log = shape(spark, sf_dir, "fetch_log").select(
        F.concat("url", F.lit("/"), (F.col("event_id") % 9).cast("string")).alias("url"), F.col("ts").cast("timestamp").alias("ts"),
        "event_id", quality.failure_class(F.col("status"), F.col("error")).alias("failure"),
    )
    log.write.parquet(f"{path}/in")
    due = stateful.retry_times(spark.readStream.schema(log.schema).parquet(f"{path}/in"), 5, 10_800_000, "1 day")
    incremental.start(due, f"{path}/rows", f"{path}/checkpoint", ()).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("url", F.unix_millis("due_at").alias("due_ms"), "attempts", "last_failure")


@query(
    f"""select source, page_no, n_links from {shape_sql('listing_pages')} p where page_no < coalesce(
      (select min(page_no) from {shape_sql('listing_pages')} e where e.source = p.source and e.n_links = 0), page_no + 1)"""
)
def stream_listing_stop(spark, sf_dir):
    """Listing pages that arrive in no order, up to each source's first empty one."""
    path = scratch(spark, "stream-listing")
    pages = shape(spark, sf_dir, "listing_pages").select("source", "page_no", "n_links")
    pages.repartition(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    incremental.start_counts(stateful.listing_state(stream), f"{path}/where", f"{path}/checkpoint").awaitTermination()
    return stateful.before_stop(spark.read.parquet(f"{path}/in"), stateful.latest_listing_state(spark, f"{path}/checkpoint"))
