"""Experience and salary ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import text as tx

RANGE = "struct<min:bigint,max:bigint>"
NOT_SPECIFIED = "Not Specified"


def _range(low: Column, high: Column) -> Column:
    whole = lambda x: x.try_cast("decimal(38,6)").try_cast("bigint")
    return F.struct(whole(low).alias("min"), whole(high).alias("max"))


def _numbers(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def experience_range(text: Column) -> Column:
    """`fresher` is 0..0, otherwise the first two numbers, without fractions; no number gives null."""
    nums = _numbers(text, r"[0-9]+(?:\.[0-9]+)?")
    return (
        F.when(tx.has_word(text, "fresher"), _range(F.lit(0), F.lit(0)))
        .when(F.size(nums) > 0, _range(F.get(nums, F.lit(0)), F.get(nums, F.lit(1))))
    )


def salary_range(text: Column) -> Column:
    """First two numbers, thousands commas and fractions removed, currency text ignored."""
    nums = _numbers(text, r"[0-9][0-9,]*(?:\.[0-9]+)?")
    return F.when(F.size(nums) > 0, _range(F.get(nums, F.lit(0)), F.get(nums, F.lit(1))))


def is_permanent(employment_type: Column) -> Column:
    return F.coalesce(tx.has_word(employment_type, "permanent"), F.lit(False))


def salary_for_type(salary: Column, employment_type: Column) -> Column:
    """Only permanent posts keep their salary."""
    return F.when(is_permanent(employment_type), salary)


def salary_text_for_type(text: Column, employment_type: Column) -> Column:
    return F.when(is_permanent(employment_type), text).otherwise(F.lit("Not specified"))
