"""Joins, union, sinks, quality and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.catalog.registry import pages as captured_pages
from hirelake.catalog.registry import query, shape, shape_sql, table
from hirelake.catalog.sql import PAGE_LINKS, host_sql
from hirelake.functions import urls
from hirelake.operators import cards, links, quality
from hirelake.plans import schema
from hirelake.session import scratch
from hirelake.sources import restated, sinks

_PAIRS = f"""(select c.job_url, trim(c.industry) as industry,
    case when contains(c.label, ' ') then regexp_extract(c.label, '^(.*) [^ ]*$', 1) else c.label end as title,
    case when contains(c.label, ' ') then split_part(c.label, ' ', -1) end as job_id,
    d.location, d.description, d.apply_url, d.job_url is not null as found
    from {shape_sql('cards')} c left join {shape_sql('details')} d on c.job_url = d.job_url)"""
_COMPLETE = "location is not null and description is not null and apply_url is not null and job_id is not null"
_COLUMNS = "job_url, industry, title, job_id, location, description, apply_url"


@query(f"select {_COLUMNS} from {_PAIRS} p where {_COMPLETE}")
def card_detail_join(spark, sf_dir):
    return cards.postings(shape(spark, sf_dir, "cards"), shape(spark, sf_dir, "details"))


@query(
    f"""select job_url, case when not found then 'detail' else concat_ws(',', case when location is null then 'location' end,
    case when description is null then 'description' end, case when apply_url is null then 'apply_url' end,
    case when job_id is null then 'job_id' end) end as missing
    from {_PAIRS} p where not ({_COMPLETE})"""
)
def card_detail_rejects(spark, sf_dir):
    judged = cards.joined(shape(spark, sf_dir, "cards"), shape(spark, sf_dir, "details"))
    return quality.rejected(judged).select("job_url", F.array_join("missing", ",").alias("missing"))


@query(
    f"""select 'location' as field, count(*) as n from {_PAIRS} p where found and location is null
    union all select 'description', count(*) from {_PAIRS} p where found and description is null
    union all select 'apply_url', count(*) from {_PAIRS} p where found and apply_url is null
    union all select 'job_id', count(*) from {_PAIRS} p where found and job_id is null
    union all select 'detail', count(*) from {_PAIRS} p where not found"""
)
def reject_reasons(spark, sf_dir):
    judged = cards.joined(shape(spark, sf_dir, "cards"), shape(spark, sf_dir, "details"))
    return quality.reject_reasons(judged)


@query(
    """select cast(c_custkey as varchar) as JobID, '"' || c_name || '", ' || chr(10) || c_mktsegment as Title, '' as Location,
    case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as EmploymentIndustry, '' as JobDescription,
    'Cisco' as Source, '["' || c_name || '"]' as JobURL from customer"""
)
def csv_roundtrip(spark, sf_dir):
    """Appended as CSV in two runs with quotes and line breaks, read back."""
    columns = schema.ITEM_FIELDS["cisco"]
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("JobID"),
        F.concat(F.lit('"'), "c_name", F.lit('", \n'), "c_mktsegment").alias("Title"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("EmploymentIndustry"),
        F.lit("Cisco").alias("Source"),
        F.array("c_name").alias("JobURL"),
    )
    path = scratch(spark, "csv")
    building = F.coalesce(F.col("EmploymentIndustry"), F.lit("")) == ""
    sinks.append_csv(rows.where(building), path, columns)
    sinks.append_csv(rows.where(~building), path, columns)
    return sinks.read_csv(spark, path, columns)


_UNION = f"""select 'alpha' as source, JobID as job_id, Title as title, EmploymentIndustry as industry, null as apply_url, null as job_url,
    null as description from {shape_sql('source_a')} a
    union all select 'beta', JobID, JobTitle, null, JobApplyLink, null, null from {shape_sql('source_b')} b
    union all select 'gamma', JobID, Title, null, null, JobLink, Description from {shape_sql('source_c')} c"""


def _union(spark, sf_dir):
    return schema.combine(
        schema.from_items(shape(spark, sf_dir, f"source_{letter}"), name)
        for letter, name in (("a", "alpha"), ("b", "beta"), ("c", "gamma"))
    )


@query(_UNION)
def postings_union(spark, sf_dir):
    return _union(spark, sf_dir).select(
        "source", "job_id", "title", F.get("employment_industry", F.lit(0)).alias("industry"), "apply_url", "job_url",
        "description",
    )


@query(f"select source, count(*) as n, count(apply_url) as n_apply from ({_UNION}) u group by source")
def typed_postings(spark, sf_dir):
    """Written as Parquet partitioned by source, read back with the declared schema."""
    path = scratch(spark, "postings")
    sinks.write_postings(_union(spark, sf_dir), path)
    back = spark.read.schema(schema.POSTING).parquet(path)
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("apply_url").alias("n_apply"))


@query(f"select ({_COMPLETE}) as accepted, count(*) as n from {_PAIRS} p group by 1")
def reject_split(spark, sf_dir):
    """Good rows and rejects from one pass, in two partitions of one table."""
    judged = cards.joined(shape(spark, sf_dir, "cards"), shape(spark, sf_dir, "details"))
    path = scratch(spark, "judged")
    sinks.split_write(judged, path)
    back = spark.read.parquet(path).withColumn("accepted", F.col("accepted").cast("boolean"))
    return back.groupBy("accepted").agg(F.count(F.lit(1)).alias("n"))


def _log(spark, sf_dir):
    log = shape(spark, sf_dir, "fetch_log")
    return log.withColumn("failure", quality.failure_class(F.col("status"), F.col("error")))


_CLASS = """case event_type when 'error' then 'http' when 'signup' then 'dns' when 'purchase' then 'timeout'
    when 'view' then 'unknown' else 'ok' end"""


@query(
    f"""select case when user_id % 3 = 0 then 'alpha' else 'beta' end as source, {_CLASS} as failure, count(*) as n
    from events where event_type <> 'click' group by 1, 2"""
)
def failure_classes(spark, sf_dir):
    return quality.failure_counts(_log(spark, sf_dir))


@query(
    f"""select url, attempts, last_failure from (
    select 'https://jobs.example.com/j/' || user_id as url, count(*) as attempts,
      arg_max({_CLASS}, (ts, event_id)) as last_failure from events group by user_id) t
    where last_failure <> 'ok' and attempts < 105"""
)
def retry_candidates(spark, sf_dir):
    return quality.retry_candidates(_log(spark, sf_dir), 105)


@query(f"select {host_sql('url')} as source, page_id as page_no, count(*) as n_links from {PAGE_LINKS} l group by 1, 2")
def page_counters(spark, sf_dir):
    rows = links.page_links(captured_pages(spark, sf_dir), keep=("page_id", "url")).select(
        urls.host(F.col("url")).alias("source"), F.col("page_id").alias("page_no")
    )
    return quality.page_counters(rows)


@query(
    f"""select source, cast(sum(n_links) as bigint) as jobs_fetched, count(*) as responses
    from {shape_sql('listing_pages')} l group by source"""
)
def source_counters(spark, sf_dir):
    return quality.source_counters(shape(spark, sf_dir, "listing_pages"))


@query(
    """select o_orderstatus as source, o_orderkey as id, cast(year(o_orderdate) as integer) as day,
    case when year(o_orderdate) >= 1995 then concat('again ', o_orderpriority) else o_orderpriority end as title
    from orders where year(o_orderdate) < 1995 or o_orderkey % 3 > 0"""
)
def restated_days(spark, sf_dir):
    """Postings by period, some periods stated a second time with fewer rows, after a run that broke off."""
    path = scratch(spark, "restated")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source"), F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("title"),
    )
    restated.restate(rows, path, "first", 1)
    restated.write_rows(rows, path, "broken")
    later = rows.where("day >= 1995 and id % 3 > 0").withColumn("title", F.concat(F.lit("again "), "title"))
    restated.restate(later, path, "second", 2)
    return restated.read(spark, path, "source string, id long, day int, title string")
