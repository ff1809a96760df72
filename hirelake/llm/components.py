"""Connected components of a graph given as edges, by alternating stars.

Every round lets each node's larger neighbours, then each node's smaller ones, meet the
smallest node of its neighbourhood. Edges only ever get shorter ways to the least node, and
the rounds end when nothing changes; their number grows with the logarithm of the size.
Neighbourhoods are never collected: a round takes minima (folded before the shuffle) and
joins them back, so a node with very many edges is split like any hot join key. Each round's
edges are written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least("u", F.min("b")).alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node `a` to the smaller `b`."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    met = edges.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long, not null) but the roots; a root is
    the least node of its component."""
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    print_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = print_of(now)
    while True:
        large = _large_star(now).where("a > b").distinct()
        now = written(_small_star(large).where("a > b").distinct(), name)
        after = print_of(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
