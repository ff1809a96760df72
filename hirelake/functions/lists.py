"""Expressions over ordered text lists. Short lists give null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import text as tx


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value computed once. A lambda would otherwise compute an expression
    from outside it again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def at(items: Column, index: int) -> Column:
    """Zero-based item; a negative index counts from the end."""
    if index < 0:
        return F.try_element_at(items, F.lit(index))
    return F.get(items, F.lit(index))


def between(items: Column, start: int = 0, drop_last: int = 0) -> Column:
    """The list without its first `start` and last `drop_last` items."""
    return F.slice(items, F.lit(start + 1), F.greatest(F.size(items) - start - drop_last, F.lit(0)))


def window(items: Column, start: int, stop: int | None = None) -> Column:
    """Items start..stop-1, clamped to the list."""
    if stop is None:
        return between(items, start)
    return F.slice(items, F.lit(start + 1), F.lit(max(stop - start, 0)))


def joined(items: Column, sep: str = "") -> Column:
    return F.array_join(items, sep)


def first_of_length(items: Column, minimum: int) -> Column:
    return F.try_element_at(F.filter(items, lambda x: F.length(x) >= minimum), F.lit(1))


def distinct_core(items: Column) -> Column:
    """Distinct in first-seen order, last two dropped, blanks dropped."""
    return F.filter(between(F.array_distinct(items), 0, 2), lambda x: x != "")


def first_filled(*lists: Column, default: str = "-") -> Column:
    """Join the parts of the first list that has any part at all."""
    picks = [F.when(F.size(items) > 0, joined(items)) for items in lists]
    return F.coalesce(*picks, F.lit(default))


def clean_skills(items: Column) -> Column:
    """Each skill up to its first no-break space; blank entries dropped before the cut."""
    kept = F.filter(items, lambda x: tx.stripped(x) != "")
    return F.transform(kept, lambda x: F.split_part(x, F.lit(tx.NBSP), F.lit(1)))


def bracketless(items: Column) -> Column:
    """A list printed with quotes and without brackets: 'a', 'b'."""
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")


def routed(rows: Column, word: str, key: str = "key", value: str = "value") -> Column:
    """Value of the last row whose key contains the word."""
    hits = F.filter(rows, lambda r: F.contains(r[key], F.lit(word)))
    return F.try_element_at(hits, F.lit(-1))[value]


def layout(items: Column) -> Column:
    """Location, salary, employment type of a posting header by the number of items:
    three items carry no salary."""
    three = F.size(items) == 3
    return F.struct(
        at(items, 0).alias("location"),
        F.when(~three, at(items, 1)).alias("salary"),
        F.when(three, at(items, 2)).otherwise(at(items, 3)).alias("employment_type"),
    )
