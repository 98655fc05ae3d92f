"""Nearest neighbours by one-bit codes: recall and scores against brute force, and the codes themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafspark.llm import bit_codes, queries

SCHEMA = "vec_id long, embedding array<double>, score double, id int, block long"


def slow(rows, k=5, step=50):
    """{(query id, vector): [(id, cosine), ...]} by all exact cosines."""
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable.append((i, tuple(map(float, v))))

    def cosine(a, b):
        big = [max(map(abs, v)) for v in (a, b)]
        a, b = [x / big[0] for x in a], [x / big[1] for x in b]
        dot = math.fsum(x * y for x, y in zip(a, b, strict=False))
        return dot / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b))

    out = {}
    for i, q in {u for u in usable if u[0] % step == 0}:
        scored = sorted(((-round(cosine(q, v), 12), j) for j, v in usable if j != i))[:k]
        out[i, q] = [(j, -s) for s, j in scored]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    return out


def test_query_recall_and_scores(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    wanted = {i: found for (i, _), found in slow(rows).items()}
    found = queries.op11_bit_codes(spark, sf_dir)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = answers(found)
    assert set(got) == set(wanted) and all(len(x) == 5 for x in got.values())
    hits = sum(len(set(got[i]) & set(wanted[i])) for i in wanted)  # equal ids and equal scores
    assert hits >= 0.99 * 5 * len(wanted)


@pytest.mark.parametrize("settings", [{}, {"BLOCK_QUERIES": 7, "SLICE_QUERIES": 3, "SLICE_ROWS": 16, "SLICE_PAIRS": 10}])
def test_recall_on_clusters_and_ties(stored, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(bit_codes, name, value)
    random = np.random.default_rng(5)
    centres = random.normal(size=(5, 24))
    rows = [(i, (centres[i % 5] + 0.3 * random.normal(size=24)).tolist()) for i in range(600)]
    rows += [(600 + i, rows[40][1]) for i in range(30)]  # ties go to the smaller ids
    got = answers(bit_codes.approximate_neighbours(stored([(*r, 0.0, 1, 2) for r in rows], SCHEMA), F.col("vec_id") % 20 == 0))
    wanted = {i: found for (i, _), found in slow(rows, step=20).items()}
    assert set(got) == set(wanted)
    assert sum(len(set(got[i]) & set(wanted[i])) for i in wanted) >= 0.98 * 5 * len(wanted)
    assert [i for i, _ in got[40]] == [600, 601, 602, 603, 604]


def test_odd_rows(stored):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-3.0, 1.0]), (50, [1e200, 1e199]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 1.0]),
        (4, None), (None, [1.0, 1.0]), (5, []), (6, [3.0]), (7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (8, [0.0, 0.0]), (9, [1e-200, 3e-200]),
    ]
    found = bit_codes.approximate_neighbours(stored([(*r, None, None, None) for r in rows], SCHEMA), F.col("vec_id") % 50 == 0)
    wanted = slow(rows)
    flat = sorted((i, n, j, s) for (i, _), best in wanted.items() for n, (j, s) in enumerate(best, 1))
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in found.collect()) == flat
    for few in ([], [(1, [1.0])], [(0, [1.0])]):
        table = stored([(*r, None, None, None) for r in few], SCHEMA)
        assert bit_codes.approximate_neighbours(table, F.col("vec_id") % 50 == 0).collect() == []


def test_codes_estimate_within_their_bounds():
    random = np.random.default_rng(1)
    points, asked = (x / bit_codes.lengths(x)[:, None] for x in (random.normal(size=(3000, 60)), random.normal(size=(40, 60))))
    codes = bit_codes.fit_codes(points[:500], 60)
    packed, centre, base, slope, wide = codes.encode(points)
    assert packed.shape == (3000, 8) and codes.dim == 64
    guess = (asked @ codes.centres.T)[:, centre] + base + slope * (codes.turned(asked) @ codes.corners(packed).T)
    away = bit_codes.lengths((asked[:, None, :] - codes.centres[None]).reshape(-1, 60)).reshape(40, -1)[:, centre]
    miss = np.abs(guess - asked @ points.T) / (wide * away)
    assert (miss <= bit_codes.EPSILON).mean() > 0.97
    assert abs((guess - asked @ points.T).mean()) < 0.01


def test_bounds_leave_most_rows_out():
    random = np.random.default_rng(2)
    points = random.normal(size=(20_000, 64))
    unit = points / bit_codes.lengths(points)[:, None]
    codes = bit_codes.fit_codes(unit[:2000], 64)
    search = bit_codes.Search(codes, np.arange(50), points[:50], 5, bit_codes.EPSILON)
    encoded = codes.encode(unit)
    for start in range(0, len(points), 2000):
        part = slice(start, start + 2000)
        search.rows(np.arange(20_000)[part], points[part], *[x[part] for x in encoded])
    assert search.compared < 0.25 * 50 * 20_000
