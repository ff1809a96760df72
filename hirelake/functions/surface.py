"""The normalisation functions as SQL functions, for those who write SQL.

`register` creates temporary functions of the session, each a formula over built-in functions.
Spark puts the formula in the place of the call, so a query in SQL has the plan of the same query
written with the column functions of this folder: nothing is called per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hirelake.functions import dates, pay
from hirelake.functions import text as tx


def literal(text: str) -> str:
    """A SQL string literal; everything but letters and digits is written by its number."""
    return "'" + "".join(c if c.isascii() and c.isalnum() else f"\\u{ord(c):04x}" for c in text) + "'"


def _cleaned() -> str:
    """One formula for all boards: with a constant board only its own case is left."""
    cases = " ".join(f"when {literal(board)} then {literal(tx.char_class(chars))}" for board, chars in tx.CONTROL_CHARS.items())
    return f"strip_text(regexp_replace(x, case board {cases} end, ''))"


def _age() -> str:
    units = " ".join(
        f"when regexp_like(x, {literal(rf'\b{unit}s?\b')}) then try_cast(try_multiply(n, {size}L) as int)"
        if size else f"when regexp_like(x, {literal(rf'\b{unit}s?\b')}) then 0"
        for unit, size in dates.UNIT_DAYS.items()
    )
    return (
        f"case when x is null or regexp_like(x, {literal(r'\b(just|today)\b')}) then 0 when regexp_like(x, {literal(r'\byesterday\b')}) then 1 "
        f"{units} else try_cast(n as int) end"
    )


def _range(found: str, value: str) -> str:
    number = lambda i: f"try_cast(try_cast({value.format(f'get({found}, {i})')} as decimal(38,6)) as bigint)"
    return f"case when size({found}) > 0 then named_struct('min', {number(0)}, 'max', {number(1)}) end"


def _formulas() -> dict[str, tuple[str, str, str]]:
    """name: (parameters, result type, formula), in the order in which they build on each other."""
    whole = f"regexp_extract_all(x, {literal(r'[0-9]+(?:\.[0-9]+)?')}, 0)"
    thousands = f"regexp_extract_all(x, {literal(r'[0-9][0-9,]*(?:\.[0-9]+)?')}, 0)"
    after_colon = "lower(strip_text(case when contains(x, ':') then split_part(x, ':', 2) else x end))"
    digits = "regexp_extract(x, '([0-9]+)', 1)"
    return {
        "strip_text": ("x string", "string", f"btrim(x, {literal(tx.WHITESPACE)})"),
        "clean_board_text": ("x string, board string", "string", _cleaned()),
        "without_crlf": ("x string", "string", f"replace(x, {literal(tx.CRLF)}, '')"),
        "join_between": (
            "parts array<string>, front int, back int", "string",
            "array_join(slice(parts, front + 1, greatest(size(parts) - front - back, 0)), '')",
        ),
        "without_ends": ("x string", "string", "substring(x, 2, greatest(length(x) - 2, 0))"),
        "age_number": ("x string", "bigint", f"case when {digits} = '' then 1L else try_cast({digits} as bigint) end"),
        "age_of_words": ("x string, n bigint", "int", _age()),
        "age_days": ("x string", "int", f"age_of_words({after_colon}, age_number({after_colon}))"),
        "posted_at": (
            "x string, as_of timestamp", "timestamp",
            f"try_subtract(as_of, make_dt_interval(case when age_days(x) <= {dates.INTERVAL_DAYS} then age_days(x) end))",
        ),
        "gmt_text": ("stamp timestamp, zone string", "string", f"date_format(date_trunc('second', to_utc_timestamp(stamp, zone)), '{dates.STAMP}')"),
        "reordered_date": (
            "x string", "string",
            "case when get(split(x, '/'), 2) is not null then concat_ws('-', get(split(x, '/'), 2), get(split(x, '/'), 1), get(split(x, '/'), 0)) end",
        ),
        "typed_date": ("x string, fmt string", "date", "try_to_date(strip_text(x), fmt)"),
        "has_word": ("x string, word string", "boolean", "contains(lower(x), word)"),
        "experience_range": (
            "x string", pay.RANGE,
            f"case when has_word(x, 'fresher') then named_struct('min', 0L, 'max', 0L) else {_range(whole, '{}')} end",
        ),
        "salary_range": ("x string", pay.RANGE, _range(thousands, "replace({}, ',', '')")),
        "is_permanent": ("x string", "boolean", "coalesce(has_word(x, 'permanent'), false)"),
        "salary_text_for_type": ("x string, kind string", "string", "case when is_permanent(kind) then x else 'Not specified' end"),
        "sentinel_to_null": ("x string, sentinel string", "string", "nullif(x, sentinel)"),
        "integer_after_colon": ("x string", "bigint", "try_cast(strip_text(split_part(x, ':', 2)) as bigint)"),
    }


def register(spark: SparkSession) -> list[str]:
    """Creates the functions in the session, in place of any of their names; returns the names."""
    made = _formulas()
    for name, (parameters, result, formula) in made.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {result} return {formula}")
    return list(made)
