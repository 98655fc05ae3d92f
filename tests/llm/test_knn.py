"""kNN join against brute force."""

import math

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from sheafspark.llm import knn, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, k=5, step=50):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[(i, tuple(math.floor(256 * float(np.float32(x))) for x in v))] = True
    out = []
    for i, q in usable:
        if i % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, s, strict=False)), j) for j, s in usable if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, start=1)]
    return sorted(out)


def test_query_equals_sql(spark, sf_dir):
    assert spark_rows(queries.op6_voronoi_knn(spark, sf_dir)) == duck_rows(connect(sf_dir), queries.OP6_SQL)


@pytest.mark.parametrize("sizes", [(1000, 20_000, 64), (7, 60, 5), (3, 1000, 40)])
def test_equals_brute_force(stored, monkeypatch, sizes):
    for name, value in zip(("BLOCK_QUERIES", "CHUNK_ROWS", "DATA_PIVOTS"), sizes, strict=True):
        monkeypatch.setattr(knn, name, value)
    random = np.random.default_rng(sizes[0])
    centres = random.normal(size=(6, 4))
    rows = [(int(i), (centres[i % 6] * random.choice([1, 1, 5]) + random.normal(size=4) * 0.05).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5, 0.25, 0.0, 1.0]) for i in range(50)]  # ties
    got = knn.knn_join(stored([(*r, 0) for r in rows], SCHEMA), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == slow(rows, step=10)


def test_many_groups_and_chunks_in_many_partitions(spark, stored, monkeypatch):
    for name, value in {"BLOCK_QUERIES": 7, "CHUNK_ROWS": 60, "DATA_PIVOTS": 5}.items():
        monkeypatch.setattr(knn, name, value)
    random = np.random.default_rng(11)
    rows = [(i, random.normal(size=8).tolist()) for i in range(400)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = knn.knn_join(stored([(*r, 0) for r in rows], SCHEMA), F.col("vec_id") % 10 == 0)
        assert sorted(tuple(r) for r in got.collect()) == slow(rows, step=10)
    finally:
        spark.conf.unset(coalesce)


def test_query_counts_repeated_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK_ROWS", 40)
    random = np.random.default_rng(12)
    rows = [(i, random.normal(size=4).tolist()) for i in range(200)]
    rows += rows[40:60] + [rows[7]] * 9 + [rows[100]]  # candidates, one more often than the answers hold, and queries
    spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    wanted = []
    for i, q in whole:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i)[:5]
            wanted += [(i, n, j, -s) for n, (s, j) in enumerate(scored, start=1)]
    assert len(wanted) == 30
    assert sorted(tuple(r) for r in queries.op6_voronoi_knn(spark, str(tmp_path)).collect()) == sorted(wanted)


def test_components_beyond_a_long(stored):
    rows = [(0, [2 / 256, -1 / 256]), (1, [1.0e17, 2.0e17]), (2, [-1.0, 0.0])]
    got = knn.knn_join(stored([(*r, 0) for r in rows], SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 0), (0, 2, 2, -512)]


def test_odd_rows(stored):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [-1.0, 0.5]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None),
        (None, [1.0, 1.0]), (5, []), (6, [3.0]), (7, [1.0, 2.0, 3.0]), (100, [nan, nan]), (150, []), (200, [3.0e30, 1.0]), (8, [2.0e6, -1.0]),
    ]
    usable = [r for r in rows if r[0] != 200]
    got = knn.knn_join(stored([(*r, None) for r in usable], SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == slow(usable)
    assert knn.knn_join(stored([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    assert knn.knn_join(stored([(1, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    assert knn.knn_join(stored([(0, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []


def test_large_whole_numbers_stay_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**30, 1.0], [2.0**30, 2.0]])
    assert knn._scores(a, b).tolist() == [[2**70 + 3, 2**70 + 6]]


def test_far_cells_are_not_replicated(stored, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 10)
    random = np.random.default_rng(0)
    centres = np.array([[9.0, 0.0], [-9.0, 0.0], [0.0, 9.0], [0.0, -9.0]])
    rows = [(i, (centres[i % 4] + random.normal(size=2) * 0.01).tolist()) for i in range(400)]
    got = knn.knn_join(stored([(*r, 0) for r in rows], SCHEMA), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == slow(rows, step=10)
