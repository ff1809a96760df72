"""Threshold algorithm and rounds of centroids against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from hirelake.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
SMALL = centroids.Settings(k=5, rounds=3, width=4)


def vectors(seed=3, n=120, width=4):
    pick = random.Random(seed)
    rows = [(i, [pick.randint(-40, 40) / 16 for _ in range(width)], 0) for i in range(n)]
    rows += [rows[7], rows[7], (7, rows[9][1], 1), (None, rows[3][1], 1)]
    rows += [(1000 + i, [0.5] * width, 0) for i in range(40)]  # a hot vector, whose centroids tie
    rows += [
        (900, None, 0), (901, [], 0), (902, [1.0] * (width - 1), 0), (903, [1.0] * (width + 1), 0),
        (904, [1.0] * (width - 1) + [None], 0), (905, [float("nan")] * width, 0), (906, [1.0] * (width - 1) + [float("-inf")], 0),
    ]
    return rows


def brute(rows, k, rounds, width, scale=64, seed=1):
    whole = []
    for key, v, *_ in rows:
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v):
            whole.append((key, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [c for _, c in sorted(whole, key=lambda r: (digest(r[0]), r[1]))[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((square(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in whole]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(whole, own) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(key, *near(v)[::-1]) for key, v in whole]
    total = sum(d for _, _, d in found)
    of = lambda c: sum(d for _, o, d in found if o == c)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, of(c), total, sha[c]) for i, c, d in found), key=repr)


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_threshold_algorithm_finds_the_nearest(spread):
    pick = np.random.default_rng(spread)
    for k, width in ((1, 1), (2, 3), (7, 2), (16, 64), (40, 5)):
        centres, points = pick.integers(-spread, spread + 1, (k, width)), pick.integers(-spread, spread + 1, (300, width))
        number, best = centroids.Lists(centres).nearest(points)
        exact = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert (number == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()


def test_walk_stops_early():
    """Well separated centroids: most are never met."""
    centres = np.arange(50)[:, None] * 1000 + np.zeros((1, 3), np.int64)
    lists, met = centroids.Lists(centres), []
    kept, np.einsum = np.einsum, lambda spec, a, b: (met.append(len(a)), kept(spec, a, b))[1]
    try:
        number, _ = lists.nearest(np.array([[20_100, 20_200, 19_900]]))
    finally:
        np.einsum = kept
    assert number[0] == 20 and len(met) < 10


def test_clusters_equal_brute_force(spark):
    rows = vectors()
    made, final = centroids.cluster(spark.createDataFrame(rows, SCHEMA), settings=SMALL, carry=["vec_id"])
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    got = sorted(((*r, digests[r["cluster"]]) for r in made.collect()), key=repr)
    assert got == brute(rows, 5, 3, 4)


def test_query_equals_brute_force(spark, tmp_path):
    rows = vectors(width=64, n=60)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op11_centroids(spark, str(tmp_path))
    assert got.dtypes[1:] == [
        ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"),
    ]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 16, 3, 64)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.5, 0.25, 0.0, -0.01], 0)]])
def test_fewer_vectors_than_centroids(spark, rows):
    made, final = centroids.cluster(spark.createDataFrame(rows, SCHEMA), settings=SMALL, carry=["vec_id"])
    assert made.columns == ["vec_id", *centroids.ADDED]
    assert [tuple(r) for r in made.collect()] == ([(1, 0, 0, 0, 0)] if rows and rows[0][1] else [])
    assert final.tolist() == ([[32, 16, 0, -1]] if len(final) else [])


def test_large_components_have_no_distance(spark):
    rows = [(1, [1e30, 0.0, 0.0, 0.0], 0), (2, [0.0] * 4, 0), (3, [1.0] * 4, 0)]
    made, final = centroids.cluster(spark.createDataFrame(rows, SCHEMA), settings=SMALL, carry=["vec_id"])
    got = {r["vec_id"]: tuple(r)[1:] for r in made.collect()}
    assert got[1] == (None, None, None, None) and len(final) == 2
    assert {got[2][0], got[3][0]} == {0, 1} and got[2][1:] == got[3][1:] == (0, 0, 0)


def test_clashing_names(spark):
    rows = [(*r, "own", "own", 5) for r in vectors(n=20)]
    df = spark.createDataFrame(rows, SCHEMA + ", _id string, cluster string, Inertia int")
    made, _ = centroids.cluster(df, settings=SMALL)
    assert made.columns == ["vec_id", "embedding", "label", "_id", *centroids.ADDED]
    plain, _ = centroids.cluster(spark.createDataFrame(vectors(n=20), SCHEMA), settings=SMALL)
    assert sorted(map(str, made.drop("_id").collect())) == sorted(map(str, plain.collect()))
