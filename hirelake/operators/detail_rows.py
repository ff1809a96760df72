"""Key/value detail rows to fields, for rows kept one per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def routed(rows: DataFrame, fields: Mapping[str, str], by: Sequence[str] = ("id",)) -> DataFrame:
    """One row per `by`: for each field the value of the last row (by seq) whose key
    contains the field's word. `rows` holds seq, key, value. Nothing is collected; each
    task folds its rows before the shuffle."""
    picks = [
        F.max(F.when(F.contains("key", F.lit(word)), F.struct("seq", "value")))["value"].alias(name)
        for name, word in fields.items()
    ]
    return rows.groupBy(*by).agg(*picks)
