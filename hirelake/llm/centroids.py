"""Centroid clustering of vectors of whole numbers, the nearest centroid found by the threshold
algorithm.

Per dimension the centroids are sorted by their value there. From a vector's own value each list
is walked outward, one centroid of each list at a time, the nearer side first. A centroid met for
the first time gets its exact squared distance. The squared gaps that the lists have reached add
up to a frontier that no centroid still unmet can lie within; the walk stops once it strictly
exceeds the best exact distance (strictly, so that a tie is met and goes to the smaller number).

A round sums and counts, per task, the vectors of each centroid; Spark adds these up, and the
k x width sums come to the driver, which takes exact floors. Vectors never move: no round shuffles
them, however large a cluster is. The prepared vectors are a table in the shared folder.

Defined cases: vectors of another length, null, or with a null or non-finite component are left
out. A component is floor(scale * x) exactly; a vector with one beyond +-2^27 is kept in the
result with null cluster and distance, and left out of starts and sums, as a squared distance
would not fit a long. The first centroids are those of the least hashes; vectors of equal hash by
their components, each row counting (repeated rows can make equal centroids; then the smaller
number gets all). With fewer than k vectors there are as many centroids. A null id hashes as an
empty one. A sum of distances that no long holds is null. An empty table gives an empty result.
The added columns take the place of input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import packed, unpacked
from hirelake.session import written

#: Components up to this size have squared distances that fit a long (up to 128 dimensions).
LARGEST = 1 << 27
ADDED_TYPES = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long"}
ADDED = tuple(ADDED_TYPES)


@dataclass(frozen=True)
class Settings:
    k: int = 16
    rounds: int = 3
    width: int = 64
    scale: int = 64
    seed: int = 1


class Lists:
    """The sorted lists of some centroids (k x width)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of every vector's nearest centroid; of equal ones the
        smaller number."""
        n, (k, width) = len(vectors), self.centroids.shape
        far = np.int64(4 * LARGEST)
        columns = np.arange(width)
        right = np.stack([np.searchsorted(self.values[:, d], vectors[:, d]) for d in range(width)], axis=1)
        left = right - 1
        number, best = np.full(n, k), np.full(n, np.iinfo(np.int64).max)
        met = np.zeros((n, k), dtype=bool)
        active = np.arange(n)
        while len(active):
            own, lo, hi = vectors[active], left[active], right[active]
            below = np.where(lo >= 0, own - self.values[np.maximum(lo, 0), columns], far)
            above = np.where(hi < k, self.values[np.minimum(hi, k - 1), columns] - own, far)
            down = below <= above
            reached = self.order[np.where(down, lo, hi), columns]
            left[active] -= down
            right[active] += ~down
            fresh = np.zeros((len(active), k), dtype=bool)
            fresh[np.arange(len(active))[:, None], reached] = True
            fresh &= ~met[active]
            met[active] |= fresh
            for c in np.flatnonzero(fresh.any(axis=0)).tolist():
                rows = active[fresh[:, c]]
                gaps = vectors[rows] - self.centroids[c]
                exact = np.einsum("ij,ij->i", gaps, gaps)
                better = (exact < best[rows]) | ((exact == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = exact[better], c
            frontier = np.minimum(below, above)
            frontier = np.einsum("ij,ij->i", frontier, frontier)
            active = active[(frontier <= best[active]) & ~met[active].all(axis=1)]
        return number, best


def components(vector: Column, width: int, scale: int) -> Column:
    """The vector's whole numbers; null if it does not count, empty if they are too large."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    small = lambda x: F.abs(x * scale) < float(LARGEST)
    wide = vector.cast("array<double>")
    whole = F.transform(wide, lambda x: F.floor(x * scale).cast("int"))
    return F.when((F.size(vector) == width) & F.forall(wide, fine), F.when(F.forall(wide, small), whole).otherwise(F.array().cast("array<int>")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _summer(lists: Lists, width: int, rows: int = 4096):
    """Per task: how many vectors each centroid has, and their sums."""
    k = len(lists.centroids)
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("dim", pa.int32()), ("total", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("_vector"), width)
            for i in range(0, len(vectors), rows):
                part = vectors[i : i + rows]
                number, _ = lists.nearest(part)
                counts += np.bincount(number, minlength=k)
                np.add.at(totals, number, part)
        used = np.flatnonzero(counts)
        dims = np.tile(np.arange(width), len(used))
        who = np.repeat(used, width)
        yield pa.record_batch([who.astype(np.int32), counts[who], dims.astype(np.int32), totals[used].ravel()], schema=schema)

    return sums


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the exact floor of the mean; one without vectors stays."""
    k, width = centroids.shape
    sums = vectors.select("_vector").mapInArrow(_summer(Lists(centroids), width), "cluster int, n long, dim int, total long")
    whole = sums.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in whole.collect():  # k x width rows at most
        out[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return out


def starts(vectors: DataFrame, settings: Settings) -> np.ndarray:
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(name, 256), "_vector").limit(settings.k).select("_vector").collect()
    return np.array([r[0] for r in first], dtype=np.int64).reshape(-1, settings.width)


def _assigner(lists: Lists, width: int, rows: int = 4096):
    kind = pa.struct([("cluster", pa.int32()), ("distance", pa.int64())])

    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            sizes = np.diff(column.offsets.to_numpy())
            counted = sizes == width
            vectors = _matrix(column, width)
            number, best = np.zeros(len(column), np.int32), np.zeros(len(column), np.int64)
            places = np.flatnonzero(counted)
            for i in range(0, len(vectors), rows):
                number[places[i : i + rows]], best[places[i : i + rows]] = lists.nearest(vectors[i : i + rows])
            yield pa.StructArray.from_arrays(
                [pa.array(number, pa.int32(), mask=~counted), pa.array(best, pa.int64(), mask=~counted)], fields=list(kind)
            )

    return assign


def _held(total: int) -> int | None:
    return total if total < 1 << 63 else None


def per_cluster(values: dict[int, object], kind: str) -> Column:
    """The value of the row's cluster; there are at most k, so they stand in the plan."""
    pairs = [F.lit(x).cast(t) for c, v in values.items() for x, t in ((c, "int"), (v, kind))]
    return F.try_element_at(F.create_map(*pairs), F.col("cluster")) if pairs else F.lit(None).cast(kind)


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings | None = None,
    carry: list[str] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """The rows whose vectors count, with the columns `carry` (all of them unless named) and
    cluster, distance, cluster_inertia and inertia; and the final centroids (k x width)."""
    settings = settings or Settings()
    carry = df.columns if carry is None else carry
    whole = packed(df, carry, _id=F.col(key), _vector=components(F.col(vector), settings.width, settings.scale))
    ready = written(whole.where(F.col("_vector").isNotNull()), "vectors")
    counted = ready.where(F.size("_vector") == settings.width)
    centroids = starts(counted, settings)
    if not len(centroids):
        return unpacked(ready.select("_in", *(F.lit(None).cast(t).alias(c) for c, t in ADDED_TYPES.items())), carry, *ADDED), centroids
    for _ in range(settings.rounds):
        centroids = moved(counted, centroids)
    udf = F.arrow_udf(_assigner(Lists(centroids), settings.width), "struct<cluster:int,distance:long>")
    assigned = written(ready.select("_in", udf("_vector").alias("_a")).select("_in", "_a.*"), "assigned")
    # At most k rows come to the driver.
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).where("cluster is not null")
    inertia = {r["cluster"]: int(r["s"]) for r in sums.collect()}
    of_cluster = per_cluster({c: _held(s) for c, s in inertia.items()}, "long")
    total = F.when(F.col("cluster").isNotNull(), F.lit(_held(sum(inertia.values()))).cast("long"))
    out = assigned.select("_in", "cluster", "distance", of_cluster.alias("cluster_inertia"), total.alias("inertia"))
    return unpacked(out, carry, *ADDED), centroids
