"""Posting ages and dates. `as_of` is always an argument, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import text as tx

# Days per unit of age.
UNIT_DAYS = {
    "minute": 0,
    "hour": 0,
    "day": 1,
    "week": 7,
    "month": 30,
    "year": 365,
}
# Words that mean the posting is from now, token by token (parity mode).
NOW_TOKENS = ["just", "today", "minutes", "hours", "hour"]

# What an interval can hold; more than that is no age.
INTERVAL_DAYS = 106_751_990
STAMP = "yyyy-MM-dd HH:mm:ss"


def _after_colon(posted: Column) -> Column:
    return F.when(F.contains(posted, F.lit(":")), F.split_part(posted, F.lit(":"), F.lit(2))).otherwise(posted)


def _count(digits: Column) -> Column:
    """The digits as a number; no digits mean one, more than a number holds mean null."""
    return F.when(digits == "", F.lit(1).cast("bigint")).otherwise(digits.try_cast("bigint"))


def _days(count: Column, unit: int = 1) -> Column:
    """Days; null where they overflow. One such page must not stop a job."""
    return F.try_multiply(count, F.lit(unit).cast("bigint")).try_cast("int")


def age_days(posted: Column) -> Column:
    """Whole days back; null text means posted now, text without a number means one unit."""
    text = F.lower(tx.stripped(_after_colon(posted)))
    number = _count(F.regexp_extract(text, "([0-9]+)", 1))
    days = F.when(text.isNull() | text.rlike(r"\b(just|today)\b"), 0).when(text.rlike(r"\byesterday\b"), 1)
    for unit, size in UNIT_DAYS.items():
        days = days.when(text.rlike(rf"\b{unit}s?\b"), _days(number, size))
    return days.otherwise(_days(number))


def age_days_parity(posted: Column) -> Column:
    """The token rule as first written: `2 months` is two days, `1 minute` is one day."""
    text = F.lower(tx.stripped(_after_colon(posted)))
    tokens = F.split(text, " ")
    head = F.get(tokens, F.lit(0))

    def digits(value: Column) -> Column:
        return _count(F.regexp_extract(value, "^([0-9]+)$", 1))

    return (
        F.when(text.isNull() | F.arrays_overlap(tokens, F.array(*[F.lit(t) for t in NOW_TOKENS])), 0)
        .when(F.array_contains(tokens, "month"), _days(digits(head), 30))
        .otherwise(_days(digits(F.replace(head, F.lit("+"), F.lit("")))))
    )


def posted_at(posted: Column, as_of: Column, parity: bool = False) -> Column:
    days = age_days_parity(posted) if parity else age_days(posted)
    return F.try_subtract(as_of, F.make_dt_interval(F.when(days <= INTERVAL_DAYS, days)))


def gmt_text(stamp: Column, zone: str | Column) -> Column:
    """Local time to GMT, whole seconds, as text."""
    utc = F.to_utc_timestamp(stamp.cast("timestamp"), zone)
    return F.date_format(F.date_trunc("second", utc), STAMP)


def reordered(text: Column) -> Column:
    """`a/b/c` to `c-b-a`, parts untouched; null unless there are three parts."""
    parts = F.split(text, "/")
    third = F.get(parts, F.lit(2))
    return F.when(third.isNotNull(), F.concat_ws("-", third, F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))


def typed_date(text: Column, fmt: str) -> Column:
    """The same text as a DATE, by the board's own format; unreadable text is null."""
    return F.try_to_date(tx.stripped(text), fmt)
