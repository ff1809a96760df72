"""SQL functions give what the column functions give, and leave no call in the plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake.functions import dates, lists, pay, surface
from hirelake.functions import text as tx

TEXTS = [
    None, "", "  a\xa0b\r\n", "Posted: 3 weeks ago", "30+ days", "Just now", "yesterday", "2 months", "5 hours", "99999999999999999999 days",
    "9999999999 years", "12/03/2024", "1/2", "a/b/c/d", "2 - 5.5 years", "Fresher", "SGD 4,000 - 6,500.50", "Permanent, Full time", "Not Specified",
    "Job Id: 42", "Job Id: x", "a: 　7 ", "one two three four",
]
PAIRS = {
    "strip_text(x)": lambda x: tx.stripped(x),
    "clean_board_text(x, 'paypal')": lambda x: tx.clean(x, "paypal"),
    "clean_board_text(x, 'quest')": lambda x: tx.clean(x, "quest"),
    "without_crlf(x)": lambda x: tx.without_crlf(x),
    "join_between(split(x, ' '), 1, 2)": lambda x: lists.joined(lists.between(F.split(x, " "), 1, 2)),
    "without_ends(x)": lambda x: tx.without_ends(x),
    "age_days(x)": lambda x: dates.age_days(x),
    "posted_at(x, t)": lambda x: dates.posted_at(x, F.col("t")),
    "gmt_text(t, 'Asia/Singapore')": lambda x: dates.gmt_text(F.col("t"), "Asia/Singapore"),
    "reordered_date(x)": lambda x: dates.reordered(x),
    "typed_date(x, 'dd/MM/yyyy')": lambda x: dates.typed_date(x, "dd/MM/yyyy"),
    "has_word(x, 'fresher')": lambda x: tx.has_word(x, "fresher"),
    "experience_range(x)": lambda x: pay.experience_range(x),
    "salary_range(x)": lambda x: pay.salary_range(x),
    "is_permanent(x)": lambda x: pay.is_permanent(x),
    "salary_text_for_type(x, x)": lambda x: pay.salary_text_for_type(x, x),
    "sentinel_to_null(x, 'Not Specified')": lambda x: tx.sentinel_to_null(x),
    "integer_after_colon(x)": lambda x: tx.integer_after_colon(x),
}


@pytest.fixture(scope="module")
def rows(spark):
    surface.register(spark)
    table = spark.createDataFrame([(t, dt.datetime(2024, 3, 5, 6, 7, 8)) for t in TEXTS], "x string, t timestamp")
    table.createOrReplaceTempView("surface_rows")
    return table


@pytest.mark.parametrize("call", PAIRS)
def test_sql_equals_columns(spark, rows, call):
    by_sql = spark.sql(f"select {call} as y from surface_rows")
    by_column = rows.select(PAIRS[call](F.col("x")).alias("y"))
    assert by_sql.collect() == by_column.collect()
    assert by_sql.schema["y"].dataType == by_column.schema["y"].dataType


@pytest.mark.parametrize("call", PAIRS)
def test_no_call_is_left_in_the_plan(spark, rows, call):
    plan = spark.sql(f"select {call} as y from surface_rows")._jdf.queryExecution().optimizedPlan().toString()
    name = call.split("(")[0]
    assert f"{name}(" not in plan and "Python" not in plan and "SQLFunction" not in plan and "Join" not in plan


SAME = [
    "strip_text(x)", "clean_board_text(x, 'paypal')", "without_crlf(x)", "without_ends(x)", "gmt_text(t, 'Asia/Singapore')",
    "has_word(x, 'fresher')", "sentinel_to_null(x, 'Not Specified')", "typed_date(x, 'dd/MM/yyyy')", "integer_after_colon(x)", "is_permanent(x)",
]


@pytest.mark.parametrize("call", SAME)
def test_plans_are_equal_after_optimisation(spark, rows, call):
    optimised = lambda df: df._jdf.queryExecution().optimizedPlan()
    by_sql = optimised(spark.sql(f"select {call} as y from surface_rows"))
    by_column = optimised(spark.table("surface_rows").select(PAIRS[call](F.col("x")).alias("y")))
    assert by_sql.sameResult(by_column)


def test_registering_again_replaces(spark, rows):
    assert surface.register(spark) == surface.register(spark)
