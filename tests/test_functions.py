"""Column functions, branch by branch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake.functions import dates, lists, pay, urls
from hirelake.functions import text as tx

NOW = dt.datetime(2024, 3, 31, 12, 0, 0)


def one(spark, values, fn, kind="string"):
    """fn over a column of values, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


AGES = {
    "just now": 0, "Today": 0, "today": 0, "yesterday": 1, "Posted Yesterday": 1, "Posted Today": 0,
    "5 minutes ago": 0, "1 minute ago": 0, "1 hour ago": 0, "3 hours ago": 0, "a month ago": 30, "1 month ago": 30,
    "2 months ago": 60, "2 weeks ago": 14, "7 days ago": 7, "30+ days ago": 30, "Posted 30+ Days Ago": 30,
    "x days ago": 1, "a year ago": 365, "": 1, "Posted: 4 days ago": 4, None: 0,
}


def test_age_days(spark):
    assert one(spark, list(AGES), dates.age_days) == list(AGES.values())


def test_age_days_parity(spark):
    want = {"2 months ago": 2, "a month ago": 30, "3 month ago": 90, "1 minute ago": 1, "5 minutes ago": 0,
            "2 weeks ago": 2, "30+ days ago": 30, "x days ago": 1, "Posted: just now": 0, "": 1, None: 0}
    assert one(spark, list(want), dates.age_days_parity) == list(want.values())


def test_unbelievable_ages_are_null(spark):
    values = ["99999999999999999999 days ago", "2000000000 days ago", "999999 years ago", "100000 days ago"]
    assert one(spark, values, dates.age_days) == [None, 2_000_000_000, 364_999_635, 100_000]
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    got = one(spark, values, lambda c: F.year(dates.posted_at(c, now)))
    assert got == [None, None, None, 1750]
    assert one(spark, values, dates.age_days_parity) == [None, 2_000_000_000, 999_999, 100_000]
    at = one(spark, values[:3], lambda c: dates.posted_at(c, F.lit(NOW)))
    assert at == [None, None, None]


def test_posted_at_moves_with_as_of(spark):
    df = spark.createDataFrame([(NOW, "2 days ago"), (NOW + dt.timedelta(days=1), "2 days ago")], "a timestamp, p string")
    got = [r[0] for r in df.select(dates.posted_at(F.col("p"), F.col("a"))).collect()]
    assert got == [NOW - dt.timedelta(days=2), NOW - dt.timedelta(days=1)]


def test_gmt_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 2, 3, 999),)], "t timestamp")
    assert df.select(dates.gmt_text(F.col("t"), "Asia/Singapore")).first()[0] == "2023-12-31 17:02:03"


def test_reordered(spark):
    want = {"12/31/2021": "2021-31-12", "1/2/2021": "2021-2-1", "31/12/2021": "2021-12-31", "2021-12-31": None, "": None}
    assert one(spark, list(want), dates.reordered) == list(want.values())


def test_typed_date(spark):
    got = one(spark, ["12/31/2021", "1/2/2021", "31/12/2021", "", None], lambda c: dates.typed_date(c, "M/d/y"))
    assert got == [dt.date(2021, 12, 31), dt.date(2021, 1, 2), None, None, None]


def test_experience(spark):
    want = {"Fresher": (0, 0), "2-5 years": (2, 5), "2 - 5 Years": (2, 5), "10+ years": (10, None), "": None, None: None, "2.5 - 4 years": (2, 4)}
    assert [r and tuple(r) for r in one(spark, list(want), pay.experience_range)] == list(want.values())


def test_salary(spark):
    want = {"60,000 - 72,000": (60000, 72000), "60000-72000": (60000, 72000), "60,000 SGD - 72,000 SGD": (60000, 72000),
            "S$5,000": (5000, None), "Not Specified": None, None: None, "99999999999 - 5": (99999999999, 5), "4,500.50 - 5,000.75": (4500, 5000),
            "Rp 3,000,000,000 - 4,000,000,000": (3_000_000_000, 4_000_000_000), "9" * 40 + " - 5": (None, 5)}
    assert [r and tuple(r) for r in one(spark, list(want), pay.salary_range)] == list(want.values())


def test_salary_needs_permanent(spark):
    got = one(spark, ["Permanent Job", "contract", None], lambda c: pay.salary_text_for_type(F.lit("5"), c))
    assert got == ["5", "Not specified", "Not specified"]


def test_strip_is_unicode(spark):
    values = ["\xa0 a b \t", "\r\n", "　x ", "plain", None]
    assert one(spark, values, tx.stripped) == [v and v.strip() for v in values]
    assert one(spark, values, tx.non_empty) == ["a b", None, "x", "plain", None]


def test_control_characters(spark):
    text = "a\r\nb\rc\nd\te\xa0f g"
    assert one(spark, [text], lambda c: tx.without_chars(c, tx.CONTROL_CHARS["paypal"])) == ["abcdefg"]
    assert one(spark, [text], lambda c: tx.without_chars(c, tx.CONTROL_CHARS["marriott"])) == ["abcdef g"]
    assert one(spark, [text], lambda c: tx.without_chars(c, tx.CONTROL_CHARS["quest"])) == ["abcd\tef g"]
    assert one(spark, [text], tx.without_crlf) == ["ab\rc\nd\te\xa0f g"]


def test_label_split(spark):
    values = ["Store Manager 12345", "12345", "", None, "Store Clerk 12 "]
    assert one(spark, values, tx.label_title) == ["Store Manager", "12345", "", None, "Store Clerk"]
    assert one(spark, values, tx.label_id) == ["12345", None, None, None, "12"]


@pytest.mark.parametrize("title,place,want", [
    ("Co-op Tech - Reno (NV)", "Reno (NV)", "Coop Tech  "), ("Tech St. Paul", "St. Paul", "Tech "),
    ("Tech-2", "Nowhere", "Tech2"), ("Tech", "", "Tech"), ("Tech-3", None, "Tech3"),
])
def test_title_before(spark, title, place, want):
    df = spark.createDataFrame([(title, place)], "t string, l string")
    assert df.select(tx.title_before(F.col("t"), F.col("l"))).first()[0] == want


def test_numbers_in_text(spark):
    assert one(spark, ["Job Id: 42", "Ref: n/a", "none", None], tx.integer_after_colon) == [42, None, None, None]
    assert one(spark, [" 10 of 1,234 ", "of x", "", None], tx.last_count) == [1234, None, None, None]


def test_icon_text(spark):
    values = ['<li><svg class="i"><use/></svg> Full time </li>', "<li><svg></svg><span> 5,000 </span></li>"]
    assert one(spark, values, tx.icon_text) == ["Full time", "5,000"]


def test_positions_clamp(spark):
    got = lambda fn: one(spark, [["a", "b", "c"], [], None], fn, "array<string>")
    assert got(lambda c: lists.at(c, 1)) == ["b", None, None]
    assert got(lambda c: lists.at(c, 3)) == [None, None, None]
    assert got(lambda c: lists.at(c, -3)) == ["a", None, None]
    assert got(lambda c: lists.at(c, -4)) == [None, None, None]
    assert got(lambda c: lists.between(c, 1, 1)) == [["b"], [], None]
    assert got(lambda c: lists.between(c, 2, 3)) == [[], [], None]
    assert got(lambda c: lists.window(c, 1, 9)) == [["b", "c"], [], None]


def test_layouts(spark):
    values = [["L", "x", "T"], ["L", "S", "x", "T"], ["L", "S"], []]
    got = [tuple(r) for r in one(spark, values, lists.layout, "array<string>")]
    assert got == [("L", None, "T"), ("L", "S", "T"), ("L", "S", None), (None, None, None)]


def test_fallback_levels(spark):
    rows = [(["a", "b"], ["c"]), ([], ["c"]), ([""], ["c"]), ([], [])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x array<string>, y array<string>")
    got = [r[0] for r in df.orderBy("i").select(lists.first_filled(F.col("x"), F.col("y"))).collect()]
    assert got == ["ab", "c", "", "-"]


def test_distinct_core(spark):
    values = [["b", "a", "b", "", "c", "x", "y"], ["a", "a"], []]
    assert one(spark, values, lists.distinct_core, "array<string>") == [["b", "a", "c"], [], []]


def test_skills_and_brackets(spark):
    assert one(spark, [["Java\xa03", " \xa0", "C"]], lists.clean_skills, "array<string>") == [["Java", "C"]]
    assert one(spark, [["a", "b"], []], lists.bracketless, "array<string>") == ["'a', 'b'", ""]


HREFS = {"/a/b": "https://x.com/a/b", "a": "https://x.com/a", "//y.com/z": "https://y.com/z", "http://q/r": "http://q/r"}


def test_absolute_and_again(spark):
    once = one(spark, list(HREFS), lambda c: urls.absolute(c, "https://x.com/"))
    assert once == list(HREFS.values())
    assert one(spark, once, lambda c: urls.absolute(c, "https://x.com/")) == once


def test_normalised(spark):
    want = {"HTTP://A.com": "http://a.com/", "http://a.com//x//y?b=2&a=1#f": "http://a.com/x/y?a=1&b=2",
            "http://a.com/x": "http://a.com/x", "/rel#f": "/rel"}
    got = one(spark, list(want), urls.normalised)
    assert got == list(want.values())
    assert one(spark, got, urls.normalised) == got


def test_host(spark):
    values = ["https://u:p@WWW.A.com:80/x", "http://a.b.c?q", "nope", None]
    assert one(spark, values, urls.host) == ["www.a.com", "a.b.c", None, None]
    assert one(spark, ["a.b.c"], urls.host_suffixes) == [["a.b.c", "b.c", "c"]]
