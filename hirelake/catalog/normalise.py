"""Text, date, pay normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.catalog.registry import query, shape, shape_sql, table
from hirelake.catalog.sql import age_days_sql, quoted, strip_sql
from hirelake.functions import dates, lists, pay
from hirelake.functions import text as tx

STAMP = "'%Y-%m-%d %H:%M:%S'"


def _deleted(x: str, chars: str) -> str:
    for c in chars:
        x = f"replace({x}, {quoted(c)}, '')"
    return x


@query(
    f"""select doc_id, {strip_sql(_deleted('text', tx.CONTROL_CHARS['paypal']))} as paypal,
    {strip_sql(_deleted('text', tx.CONTROL_CHARS['marriott']))} as marriott,
    {strip_sql(_deleted('text', tx.CONTROL_CHARS['quest']))} as quest,
    replace(text, chr(13) || chr(10), '') as lockheed,
    replace(text, chr(10), '') as monster_sg, {strip_sql('text')} as trimmed from documents"""
)
def clean_text(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.clean(text, "paypal").alias("paypal"),
        tx.clean(text, "marriott").alias("marriott"),
        tx.clean(text, "quest").alias("quest"),
        tx.without_crlf(text).alias("lockheed"),
        tx.without_chars(text, tx.CONTROL_CHARS["monster_sg"]).alias("monster_sg"),
        tx.stripped(text).alias("trimmed"),
    )


@query(
    """select doc_id, array_to_string(p[3:greatest(len(p) - 3, 0)], '') as middle, array_to_string(p[3:greatest(len(p) - 1, 0)], '') as tail_cut,
    array_to_string(p[1:greatest(len(p) - 12, 0)], '') as short, substring(text, 2, greatest(length(text) - 2, 0)) as inner_text
    from (select doc_id, text, string_split(text, ' ') as p from documents) t"""
)
def trim_join(spark, sf_dir):
    parts = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        lists.joined(lists.between(parts, 2, 3)).alias("middle"),
        lists.joined(lists.between(parts, 2, 1)).alias("tail_cut"),
        lists.joined(lists.between(parts, 0, 12)).alias("short"),
        tx.without_ends(F.col("text")).alias("inner_text"),
    )


POSTED = shape_sql("posted_text")


@query(
    f"""select id, posted, {age_days_sql('posted')} as days,
    strftime(as_of - to_days(cast({age_days_sql('posted')} as integer)), {STAMP}) as posted_at from {POSTED} t"""
)
def relative_age(spark, sf_dir):
    posted = F.col("posted")
    at = dates.posted_at(posted, F.col("as_of"))
    return shape(spark, sf_dir, "posted_text").select(
        "id", "posted", dates.age_days(posted).alias("days"), F.date_format(at, dates.STAMP).alias("posted_at")
    )


_BODY = f"lower({strip_sql('''case when contains(posted, ':') then split_part(posted, ':', 2) else posted end''')})"


@query(
    f"""select id, case when posted is null or len(list_intersect(k, ['just', 'today', 'minutes', 'hours', 'hour'])) > 0 then 0
    when list_contains(k, 'month') then 30 * coalesce(try_cast(k[1] as integer), 1)
    else coalesce(try_cast(replace(k[1], '+', '') as integer), 1) end as days
    from (select id, posted, string_split({_BODY}, ' ') as k from {POSTED} t) u"""
)
def relative_age_parity(spark, sf_dir):
    """The token rule as first written, quirks and all."""
    return shape(spark, sf_dir, "posted_text").select("id", dates.age_days_parity(F.col("posted")).alias("days"))


@query(f"select event_id, strftime(date_trunc('second', ts) - interval 330 minute, {STAMP}) as posted_at from events")
def to_gmt(spark, sf_dir):
    """Local stamps of a zone without daylight saving."""
    return table(spark, sf_dir, "events").select(
        "event_id", dates.gmt_text(F.col("ts"), "Asia/Kolkata").alias("posted_at")
    )


@query(
    f"""select id, posted, case when len(p) >= 3 then p[3] || '-' || p[2] || '-' || p[1] end as posted_at,
    strftime(try_strptime(posted, '%m/%d/%Y'), '%Y-%m-%d') as posted_date
    from (select id, posted, string_split(posted, '/') as p from {shape_sql('slash_dates')} t) u"""
)
def date_reorder(spark, sf_dir):
    posted = F.col("posted")
    return shape(spark, sf_dir, "slash_dates").select(
        "id", "posted", dates.reordered(posted).alias("posted_at"),
        dates.typed_date(posted, "M/d/y").cast("string").alias("posted_date"),
    )


PAY = shape_sql("pay_and_experience")


@query(
    f"""select id, experience, case when contains(lower(experience), 'fresher') then 0 else cast(n[1] as bigint) end as low,
    case when contains(lower(experience), 'fresher') then 0 else cast(n[2] as bigint) end as high
    from (select id, experience, regexp_extract_all(experience, '[0-9]+') as n from {PAY} t) u"""
)
def experience_range(spark, sf_dir):
    r = pay.experience_range(F.col("experience"))
    return shape(spark, sf_dir, "pay_and_experience").select(
        "id", "experience", r["min"].alias("low"), r["max"].alias("high")
    )


@query(
    f"""select id, salary, cast(replace(n[1], ',', '') as bigint) as low, cast(replace(n[2], ',', '') as bigint) as high
    from (select id, salary, regexp_extract_all(salary, '[0-9][0-9,]*') as n from {PAY} t) u"""
)
def salary_range(spark, sf_dir):
    r = pay.salary_range(tx.sentinel_to_null(F.col("salary")))
    return shape(spark, sf_dir, "pay_and_experience").select(
        "id", "salary", r["min"].alias("low"), r["max"].alias("high")
    )


@query(
    f"""select id, employment_type, contains(lower(employment_type), 'permanent') as permanent,
    case when contains(lower(employment_type), 'permanent') then cast(replace(n[1], ',', '') as bigint) end as low,
    case when contains(lower(employment_type), 'permanent') then salary else 'Not specified' end as salary_raw
    from (select id, salary, employment_type, regexp_extract_all(salary, '[0-9][0-9,]*') as n from {PAY} t) u"""
)
def salary_override(spark, sf_dir):
    kind = F.col("employment_type")
    kept = pay.salary_for_type(pay.salary_range(tx.sentinel_to_null(F.col("salary"))), kind)
    return shape(spark, sf_dir, "pay_and_experience").select(
        "id", "employment_type", tx.has_word(kind, "permanent").alias("permanent"), kept["min"].alias("low"),
        pay.salary_text_for_type(F.col("salary"), kind).alias("salary_raw"),
    )


@query("select o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') as priority from orders")
def sentinel_null(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.sentinel_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED").alias("priority")
    )


@query(
    f"""select id, try_cast(trim(split_part(coalesce(badge4, badge3), ':', 2)) as bigint) as job_id
    from {shape_sql('badges')} t"""
)
def job_id_parse(spark, sf_dir):
    return shape(spark, sf_dir, "badges").select(
        "id", tx.integer_after_colon(F.coalesce("badge4", "badge3")).alias("job_id")
    )


@query("select doc_id, contains(lower(text), 'the') as has_the, contains(lower(source), 'web') as from_web from documents")
def keyword_test(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.has_word(F.col("text"), "the").alias("has_the"), tx.has_word(F.col("source"), "web").alias("from_web")
    )
