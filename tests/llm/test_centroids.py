"""Centroid clustering against brute force over whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows

from sheafspark.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<double>, cluster string, key int, distance double"


def slow(rows, k=40, rounds=5, width=64):
    """All distances to all centroids, in Python's own whole numbers."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(row):
        key = "g" if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest()
        return key, row[1]

    points = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(points))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in set(own):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == n]
            points[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in last)
    part = {n: sum(d for _, d, c in last if c == n) for n in {c for *_, c in last}}
    digest = {n: hashlib.sha256(",".join(map(str, points[n])).encode()).hexdigest() for n in part}
    fits = lambda x: x if x < 2**63 else None
    return sorted(((i, n, fits(d), fits(part[n]), fits(total), digest[n]) for i, d, n in last), key=repr)


def got(df, **settings):
    settings = {"width": 64, **settings}
    found = centroids.with_inertia(*centroids.cluster_vectors(df, **settings))
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def test_query_equals_sql(spark, sf_dir):
    assert spark_rows(queries.op12_centroids(spark, sf_dir)) == duck_rows(connect(sf_dir), queries.OP12_SQL)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = queries.op12_centroids(spark, sf_dir)
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr) == slow(rows)


@pytest.mark.parametrize("slice_rows", [4096, 3])
def test_equals_brute_force_with_ties(stored, monkeypatch, slice_rows):
    monkeypatch.setattr(centroids, "SLICE_ROWS", slice_rows)
    random = np.random.default_rng(3)
    rows = [(i, (random.integers(-2, 3, 3) / 256).tolist()) for i in range(60)]  # few places: equal distances, empty centroids
    table = stored([(*r, "c", 1, 0.5) for r in rows], SCHEMA)
    assert got(table, width=3, k=8, rounds=3) == slow(rows, k=8, rounds=3, width=3)


def test_odd_rows(stored):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [-1.0, 0.0]), (None, [3.0, 1.0]), (None, None), (2, [1.0]), (3, [1.0, 2.0, 3.0]),
        (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [-0.001, 0.0]), (9, [3e10, -1.0]), (10, [3e30, 1.0]),
    ]
    table = stored([(*r, None, None, None) for r in rows], SCHEMA)
    for k in (2, 40):
        assert got(table, width=2, k=k) == slow(rows, k=k, width=2)
    assert got(stored([], SCHEMA)) == []
    assert got(stored([(1, [1.0], None, None, None)], SCHEMA), width=2) == []


def test_zero_favours_the_smaller_number_and_types_agree():
    points = [(0, 0), (4, 0), (0, 4), (4, 0)]
    x = np.array([[2.0, 0.0], [0.0, 2.0], [2.0, 2.0], [4.0, 0.0], [3.0, 3.0]])
    assert centroids.Bisectors(points).nearest(x)[0].tolist() == [0, 0, 0, 1, 1]
    for scale in (2**24, 2**29, 2**70):  # doubles, longs, numbers of any size
        big = centroids.Bisectors([tuple(scale * c for c in p) for p in points])
        own, far = big.nearest(x * scale)
        assert own.tolist() == [0, 0, 0, 1, 1]
        assert far == [4 * scale**2, 4 * scale**2, 8 * scale**2, 0, 10 * scale**2]
