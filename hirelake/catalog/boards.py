"""The boards' detail pages to postings, over pages written from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.catalog.html_shapes import DETAIL_HTML, RITEAID_LISTING, detail_pages
from hirelake.catalog.registry import query, shape, shape_sql, spread_table
from hirelake.plans import boards, pipeline, schema
from hirelake.sources import sinks

AGE = "strftime(timestamp '2021-12-31 10:20:30' - to_days({}), '%Y-%m-%d %H:%M:%S')"


def _items(postings, board, *columns):
    """The board's item fields, ranges and lists rendered as text."""
    view = schema.item_view(schema.conform(postings), board)
    return sinks.rendered(view, schema.ITEM_FIELDS[board]).select(*columns)


@query(
    f"""select p_name as JobTitle, p_brand as EmployerName, p_type as Location,
    case when p_partkey % 4 = 0 then '{{"min":0,"max":0}}' else '{{"min":' || p_size || ',"max":' || (p_size + 3) || '}}' end as Experience,
    case when p_size > 25 and p_partkey % 3 <> 0 then '{{"min":' || p_size || '000,"max":' || (p_size + 9) || '000}}' else '' end as Salary,
    case when p_size > 25 then 'Permanent Job' else 'Contract' end as EmploymentType,
    cast(case when p_partkey % 2 = 0 then p_partkey + 7 else p_partkey end as varchar) as JobID,
    'https://www.monster.com.sg/job/' || p_partkey as JobApplyLink, {AGE.format('p_size')} as PostedAt,
    case p_partkey % 4 when 0 then 'Do ' || p_name || ' & more' when 1 then p_name || p_type when 2 then p_name else '-' end as JobDescription,
    '["' || p_name || '","' || p_brand || '"]' as Skills, p_type as EmploymentIndustry,
    case when p_partkey % 5 = 0 then p_brand else 'IT' end as JobFunction,
    ' https://www.monster.com.sg' as Source, 'SGD - S$' as Currency, '' as JobURL from part"""
)
def board_monster_sg(spark, sf_dir):
    return _items(
        boards.monster_sg(detail_pages(spark, sf_dir, "monster_sg")), "monster_sg",
        "JobTitle", "EmployerName", "Location", "Experience", "Salary", "EmploymentType", "JobID", "JobApplyLink",
        "PostedAt", "JobDescription", "Skills", "EmploymentIndustry", "JobFunction", "Source", "Currency", "JobURL",
    )


@query(
    f"""select p_name as Title, p_type as Location, case when p_partkey % 2 = 0 then p_size || ',000 - ' || (p_size + 9) || ',000 INR' else '' end as Salary,
    'Full time' as EmploymentType, p_brand as EmployerName, 'Make ' || p_name || 'and' || p_type || ' & co' as JobDescription,
    'https://www.careerjet.co.in/apply/' || p_partkey as ApplyLink, {AGE.format('p_size')} as PostedAt,
    'https://www.careerjet.co.in/job/' || p_partkey as JobURL, 'https://www.careerjet.co.in/jobs-in-india-83624.html' as Source from part"""
)
def board_careerjet(spark, sf_dir):
    fields = schema.ITEM_FIELDS["careerjet"]
    return _items(boards.careerjet(detail_pages(spark, sf_dir, "careerjet")), "careerjet", *fields)


@query(
    """select p_name as Title, p_type as Location, p_brand as EmploymentIndustry, 'Full time' as EmploymentType,
    'https://jobsearch.paypal-corp.com/job/' || p_partkey as JobURL, case when p_partkey % 7 = 0 then '' else 'R' || p_partkey end as JobID,
    '2021-' || (1 + p_size % 28) || '-12' as PostedAt, 'https://jobsearch.paypal-corp.com/' as Source, 'PayPal' as EmployerName,
    case when p_partkey % 3 = 0 then '' else p_size || '-' || (p_size + 2) || ' years' end as Experience,
    'Run' || p_name || 'fast' as JobDescription from part"""
)
def board_paypal(spark, sf_dir):
    return _items(boards.paypal(detail_pages(spark, sf_dir, "paypal")), "paypal", *schema.ITEM_FIELDS["paypal"])


@query(
    """select 'Coop ' || p_name || '  ' as Title, p_type || ' (US)' as Location, 'Part time' as EmploymentType, p_brand as EmploymentIndustry,
    'Test ' || p_name || 'now' as JobDescription, 'J' || p_partkey as JobID,
    '2021-' || (1 + p_size % 28) || '-' || (1 + p_size % 12) as PostedAt,
    'https://careers.questdiagnostics.com/job/' || p_partkey as JobURL, 'Quest Diagnostics' as Source from part"""
)
def board_quest(spark, sf_dir):
    return _items(boards.quest(detail_pages(spark, sf_dir, "quest")), "quest", *schema.ITEM_FIELDS["quest"])


@query(
    """select p_name as Title, p_type as Location,
    case when p_partkey % 4 = 0 then '' else '["' || p_brand || '","Space"]' end as EmploymentIndustry,
    '' as EmploymentType, '' as JobURL, p_partkey || 'BR' as JobID, '2021-' || (1 + p_size % 28) || '-' || (1 + p_size % 12) as PostedAt,
    'Lockheed Martin' as Source, '' as EmployerName, '' as Experience,
    p_name || p_type || 'Job ID: ' || p_partkey || 'BR' || case when p_partkey % 4 = 0 then '' else p_brand || 'Space' end
      || 'Date' || (1 + p_size % 12) || '/' || (1 + p_size % 28) || '/2021' || 'Build ' || p_name as JobDescription,
    'https://apply.example.com/' || p_partkey as ApplyLink from part"""
)
def board_lockheed(spark, sf_dir):
    return _items(boards.lockheed(detail_pages(spark, sf_dir, "lockheed")), "lockheed", *schema.ITEM_FIELDS["lockheed"])


@query(
    """select cast(p_partkey as varchar) as JobID, p_name || ' lead' as Title, p_type as Location, p_brand as EmploymentIndustry,
    'Keep ' || p_name || ' well' as JobDescription, 'Cisco' as Source, 'https://jobs.cisco.com/jobs/' || p_partkey as JobURL from part"""
)
def board_cisco(spark, sf_dir):
    return _items(boards.cisco(detail_pages(spark, sf_dir, "cisco")), "cisco", *schema.ITEM_FIELDS["cisco"])


@query(
    f"""select 'JR' || p_partkey as JobID, p_name as Title, {AGE.format('p_size')} as PostedAt, p_type as Location,
    'Full time' as EmploymentType, repeat('Move goods. ', 20) || p_brand as Description, '' as Source, '' as PAGE, '' as ApplyLink from part"""
)
def board_mckesson(spark, sf_dir):
    return _items(boards.mckesson(detail_pages(spark, sf_dir, "mckesson")), "mckesson", *schema.ITEM_FIELDS["mckesson"])


@query(
    """select cast(o_orderkey as varchar) as JobID, 'Store Clerk' as Title, 'Aisle ' || o_custkey as Location,
    o_orderstatus || ' team' as EmploymentIndustry, 'Sell ' || o_orderpriority || ' daily' as JobDescription,
    'https://careers.riteaid.com/jobs?page=1' as Source, 'RiteAid' as EmployerName, '/apply/' || o_orderkey as ApplyLink,
    'https://careers.riteaid.com/jobs/' || o_orderkey as JobURL
    from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'"""
)
def board_riteaid(spark, sf_dir):
    """Listing cards joined with detail pages; no id in the label or no description: left out."""
    listings = spread_table(spark, sf_dir, "orders", "o_orderkey").select(F.expr(RITEAID_LISTING).alias("html"))
    postings = boards.riteaid(listings, detail_pages(spark, sf_dir, "riteaid"))
    return _items(postings, "riteaid", *schema.ITEM_FIELDS["riteaid"])


@query(
    f"""select c_name as Title, 'https://jobs.marriott.com/marriott/jobs/' || id as JobLink,
    '''' || c_mktsegment || ''', ''' || r_name || '''' as JobFunction, cast(id as varchar) as JobID,
    case when id % 10 <> 0 then concat_ws(' ', n_name, r_name, n_name, cast(n_nationkey as varchar), cast(id % 1000 as varchar)) else '' end as Location,
    'FULL_TIME' as EmploymentType, 'Work at' || n_name || 'for ' || c_mktsegment || ' & more' as Description, '' as PAGE,
    '2021-0' || (1 + id % 9) || '-11T08:00:00+0000' as PostedAt, '' as EmployerName, 'https://apply.example.com/' || id as ApplyLink,
    '' as Source, 'Entry Level' as Experience, c_mktsegment as EmploymentIndustry from {shape_sql('job_api')} t"""
)
def board_marriott(spark, sf_dir):
    captures = shape(spark, sf_dir, "job_api").select("body", F.expr("timestamp '2021-12-31 10:20:30'").alias("captured_at"))
    return _items(boards.marriott(captures), "marriott", *schema.ITEM_FIELDS["marriott"])


@query(
    """select source, count(*) as n, count(job_id) as n_ids, count(posted_on) as n_dates, min(posted_on) as first_day from (
    select b as source, case when b = 'careerjet' or (b = 'paypal' and p_partkey % 7 = 0) then null else p_partkey end as job_id,
      case when b = 'cisco' then null when b = 'paypal' then strftime(make_date(2021, 12, 1 + p_size % 28), '%Y-%m-%d')
        when b in ('quest', 'lockheed') then strftime(make_date(2021, 1 + p_size % 12, 1 + p_size % 28), '%Y-%m-%d')
        else strftime(date '2021-12-31' - p_size, '%Y-%m-%d') end as posted_on
    from part, (select unnest(['monster_sg', 'careerjet', 'paypal', 'quest', 'lockheed', 'cisco', 'mckesson']) as b) boards
    union all select 'riteaid', o_orderkey, null from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'
    union all select 'marriott', id, '2021-0' || (1 + id % 9) || '-11' from """ + shape_sql("job_api") + """ j) t
    group by source"""
)
def all_boards(spark, sf_dir):
    """Nine boards in one canonical table, then counted per board."""
    found = [fn(detail_pages(spark, sf_dir, board)) for board, fn in boards.BOARDS.items()]
    listings = spread_table(spark, sf_dir, "orders", "o_orderkey").select(F.expr(RITEAID_LISTING).alias("html"))
    api = shape(spark, sf_dir, "job_api").select("body", F.expr("timestamp '2021-12-31 10:20:30'").alias("captured_at"))
    merged = schema.combine([*found, boards.riteaid(listings, detail_pages(spark, sf_dir, "riteaid")), boards.marriott(api)])
    posted = F.coalesce(F.col("posted_at").cast("date"), F.col("posted_date")).cast("string")
    return merged.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("job_id").alias("n_ids"), F.count(posted).alias("n_dates"),
        F.min(posted).alias("first_day"),
    )


@query(
    f"""select source, accepted, count(*) as n, count(job_id) as n_ids from (
    select b as source, true as accepted, case when b = 'careerjet' or (b = 'paypal' and p_partkey % 7 = 0) then null else p_partkey end as job_id
    from part, (select unnest(['monster_sg', 'careerjet', 'paypal', 'quest', 'lockheed', 'cisco', 'mckesson']) as b) boards
    union all select 'riteaid', o_orderstatus <> 'P' and o_orderpriority <> '5-LOW', case when o_orderpriority <> '5-LOW' then o_orderkey end from orders
    union all select 'marriott', true, id from {shape_sql('job_api')} j) t group by source, accepted"""
)
def postings_pipeline(spark, sf_dir):
    """All captures in one table to all boards' postings and rejects, counted."""
    captured = [detail_pages(spark, sf_dir, board) for board in DETAIL_HTML]
    listings = spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        F.lit("riteaid").alias("source"), F.lit("listing").alias("kind"), F.col("o_orderkey").alias("page_no"),
        F.lit("https://careers.riteaid.com/jobs?page=1").alias("url"), F.expr(RITEAID_LISTING).alias("html"),
        F.expr("timestamp '2021-12-31 10:20:30'").alias("captured_at"),
    )
    pages = reduce(DataFrame.unionByName, [*captured, listings])
    api = shape(spark, sf_dir, "job_api").select("body", F.expr("timestamp '2021-12-31 10:20:30'").alias("captured_at"))
    judged = pipeline.all_judged(pages, api)
    return judged.groupBy("source", "accepted").agg(F.count(F.lit(1)).alias("n"), F.count("job_id").alias("n_ids"))
