"""The normalisation functions called from SQL; each query has the checking SQL of its DataFrame twin."""

from __future__ import annotations

from hirelake.catalog import normalise  # noqa: F401  (its SQL comes first)
from hirelake.catalog.registry import ORACLES, query, shape, table
from hirelake.functions import dates, surface


def _ask(spark, text, **tables):
    surface.register(spark)
    return spark.sql(text, **tables)


@query(f"select doc_id, paypal, marriott, quest, lockheed, trimmed from ({ORACLES['clean_text']}) c")
def sql_clean_text(spark, sf_dir):
    return _ask(
        spark,
        """select doc_id, clean_board_text(text, 'paypal') as paypal, clean_board_text(text, 'marriott') as marriott,
        clean_board_text(text, 'quest') as quest, without_crlf(text) as lockheed, strip_text(text) as trimmed from {documents}""",
        documents=table(spark, sf_dir, "documents"),
    )


@query(ORACLES["relative_age"])
def sql_relative_age(spark, sf_dir):
    return _ask(
        spark,
        "select id, posted, age_days(posted) as days, date_format(posted_at(posted, as_of), '" + dates.STAMP + "') as posted_at from {posted_text}",
        posted_text=shape(spark, sf_dir, "posted_text"),
    )


@query(ORACLES["salary_override"])
def sql_salary_override(spark, sf_dir):
    return _ask(
        spark,
        """select id, employment_type, has_word(employment_type, 'permanent') as permanent,
        case when is_permanent(employment_type) then salary_range(sentinel_to_null(salary, 'Not Specified')) end.min as low,
        salary_text_for_type(salary, employment_type) as salary_raw from {jobs}""",
        jobs=shape(spark, sf_dir, "pay_and_experience"),
    )
