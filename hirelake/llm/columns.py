"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once: a lambda argument is never inlined."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of other characters than SPACES; null and blank texts have none."""
    return F.array_remove(F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), "[\\x20\\x09-\\x0D]+"), "")


def packed(df: DataFrame, carry: list[str], **named: Column) -> DataFrame:
    """The columns `carry` as one struct `_in`, beside the named ones, so that no name clashes."""
    whole = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    return df.select(whole.alias("_in"), *(c.alias(k) for k, c in named.items()))


def unpacked(df: DataFrame, carry: list[str], *added: Column | str) -> DataFrame:
    """The carried columns again and the added ones; a carried column of an added one's name gives way."""
    new = [F.col(c) if isinstance(c, str) else c for c in added]
    taken = {n.lower() for n in df.select(*new).columns}
    return df.select(*(F.col("_in")[c].alias(c) for c in carry if c.lower() not in taken), *new)


def bit_table(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A table of `bits` (a power of two) truth values, true where some hash has that remainder.
    At most bits / 64 rows come to the driver, whatever the number of hashes."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1).cast("long"))
    words = (
        hashes.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    ).toPandas()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def returned(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, after which the worker gives back memory that it does not use: it lives on, idle, beside
    tasks that need no Python."""

    def trimmed(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        pa.system_memory_pool().release_unused()

    return trimmed
