import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafspark.operators.durations import duration_columns, duration_stats
from sheafspark.operators.logstats import download_stats, render_download_stats, render_upload_stats, status_histogram, upload_stats
from sheafspark.operators.numbering import number_rows
from sheafspark.schemas import REQUEST_LOG


def nearest_rank(values):
    """The statistics by sorting, in the arithmetic they are defined in."""
    ordered = sorted(values)
    n = len(ordered)

    def at(quantile):
        return int(ordered[int(np.float32(n) * np.float32(quantile))] * 1000)

    return (n, int(sum(ordered) / n * 1000), int(ordered[n // 2] * 1000), at(0.95), at(0.99), int(ordered[-1] * 1000))


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100, 101, 5000])
def test_quantiles(spark, n):
    rng = random.Random(n)
    values = [rng.choice([0.0, 0.001, 0.25, rng.expovariate(0.2), rng.random() * 100]) for _ in range(n)]
    got = duration_stats(spark.createDataFrame([(v,) for v in values], "s DOUBLE"), "s").first()
    expected = nearest_rank(values)
    assert (got.n, *got[2:]) == (expected[0], *expected[2:])
    assert abs(got.mean_ms - expected[1]) <= 1


def test_single_values_and_empty_input(spark):
    def stats(values):
        return tuple(duration_stats(spark.createDataFrame([(v,) for v in values], "s DOUBLE"), "s").first())

    assert stats([]) == (0, 0, 0, 0, 0, 0)
    assert stats([1.0]) == (1, 1000, 1000, 1000, 1000, 1000)
    assert stats([1.005])[1:] == (1004, 1004, 1004, 1004, 1004)
    assert stats([None, 2.0])[0] == 1


def test_what_is_no_duration_is_left_out(spark):
    values = [float("nan"), float("inf"), -float("inf"), 1e300, None, 1.0, 3.0]
    got = duration_stats(spark.createDataFrame([(v,) for v in values], "s DOUBLE"), "s").first()
    assert (got.n, got.mean_ms, got.q50_ms, got.max_ms) == (2, 2000, 3000, 3000)


def test_cells_do_not_meet_in_one_task(spark):
    rows = spark.range(200_000).select((F.col("id") / 7).alias("s"))
    stats = duration_stats(rows, "s")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "cells" not in plan
    assert tuple(stats.first())[2:] == nearest_rank([i / 7 for i in range(200_000)])[2:]


def test_the_input_is_read_once(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(1000).select((F.col("id") / 7).alias("s"), (F.col("id") % 3).alias("k")).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(counted, "s double, k long")
    for by in ([], ["k"]):
        stats = duration_stats(rows, "s", by)
        assert stats.collect() and not any(path in f for f in stats.inputFiles())
    assert reads.value == 2000


def test_groups_with_a_hot_one(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 50}", rng.expovariate(1)) for i in range(9000)] + [(None, 5.0)]
    got = {r.k: tuple(r)[1:] for r in duration_stats(spark.createDataFrame(rows, "k STRING, s DOUBLE"), "s", ["k"]).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        expected = nearest_rank(values)
        assert got[k][2:] == expected[2:] and abs(got[k][1] - expected[1]) <= 1


def test_several_columns(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a DOUBLE, b DOUBLE")
    got = {r.metric: (r.n, r.max_ms) for r in duration_columns(rows, ["a", "b"], []).collect()}
    assert got == {"a": (2, 3000), "b": (1, 2000)}


def log(spark, rows):
    full = [("f0", i, 0, 1, status, None, out, got, req, proc, err) for i, (status, out, got, req, proc, err) in enumerate(rows)]
    return spark.createDataFrame(full, REQUEST_LOG)


def test_upload_stats(spark):
    rows = [
        (200, 100, 10, 1.0, 0.5, None), (200, 200, 20, 2.0, 1.5, None), (503, 300, 30, 9.0, 8.0, None),
        (None, 400, 40, 7.0, 7.0, "reset"), (404, None, None, None, None, None),
    ]
    got = upload_stats(log(spark, rows)).first()
    assert (got.total, got.errors, got.error_responses, got.requests) == (5, 1, 2, 4)
    assert got.success_percent == pytest.approx(40.0)
    assert (got.bytes_in, got.bytes_out, got.bytes_in_mean) == (60, 600, 15.0)
    assert (got.request_max_ms, got.processing_max_ms, got.processing_mean_ms) == (9000, 1500, 1000)
    assert [tuple(r) for r in status_histogram(log(spark, rows)).collect()] == [(200, 2), (404, 1), (503, 1)]


def test_the_log_is_read_once(spark, tmp_path):
    rows = [(200, i, i, i / 100, i / 200, None) for i in range(100)] + [(503, 1, 1, 1.0, 1.0, None)]
    log(spark, rows).write.parquet(str(tmp_path / "log"))
    stats = upload_stats(spark.read.schema(REQUEST_LOG).parquet(str(tmp_path / "log")))
    assert stats.first().status_codes == "200:100, 503:1"
    # histogram cells were stored, and everything else comes from there
    plan = stats._jdf.queryExecution().optimizedPlan().toString() + "".join(stats.inputFiles())
    assert "log-cells" in plan and str(tmp_path) not in plan


def test_report_lines(spark):
    rows = [(200, 100, 10, 1.0, 0.5, None), (404, 1, 1, 2.0, 1.0, None), (None, 1, 1, 1.0, 1.0, "reset")]
    lines = {r.label: r.value for r in render_upload_stats(upload_stats(log(spark, rows)), concurrency=2).collect()}
    assert lines["Uploads [total, concurrency]"] == "3, 2" and lines["Status Codes [code:count]"] == "200:1, 404:1"
    none = render_upload_stats(upload_stats(log(spark, rows[2:]), ["file"])).collect()
    assert {r.file for r in none} == {"f0"} and not any("Latencies" in r.label for r in none)
    empty = spark.createDataFrame([], "status INT, body STRING, request_s DOUBLE, processing_s DOUBLE, bytes_in BIGINT")
    assert [r.label for r in render_download_stats(download_stats(empty)).collect()] == ["Pages [total]", "Resources [total]", "Bytes In [total, mean]"]


def test_upload_stats_without_answers(spark):
    failed = log(spark, [(None, 1, 1, 1.0, 1.0, "reset")])
    got = upload_stats(failed).first()
    assert (got.total, got.requests, got.bytes_in_mean, got.request_mean_ms) == (1, 0, None, 0)
    assert [tuple(r) for r in status_histogram(failed).collect()] == [(200, 0)]
    empty = upload_stats(log(spark, [])).first()
    assert (empty.total, empty.success_percent) == (0, None)


def test_download_stats(spark):
    def page(n):
        return '{"entry":[' + ",".join(['{"resource":{"resourceType":"A"}}'] * n) + "]}"

    rows = [(200, page(10), 1.0, 0.5, 100), (200, page(15), 2.0, 0.5, 50), (200, page(12), 3.0, 0.5, 51), (404, "{}", 9.0, 9.0, 999)]
    got = download_stats(spark.createDataFrame(rows, "status INT, body STRING, request_s DOUBLE, processing_s DOUBLE, bytes_in BIGINT")).first()
    assert (got.pages, got.resources, got.resources_min, got.resources_mean, got.resources_max) == (4, 37, 10, 12, 15)
    assert (got.bytes_in, got.bytes_in_mean, got.request_max_ms) == (201, 67.0, 3000)


def test_row_numbers(spark):
    rng = random.Random(3)
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 5}", rng.random(), i) for i in range(3000)]
    got = number_rows(spark.createDataFrame(rows, "k STRING, v DOUBLE, i INT"), ["v"], ["k"]).collect()
    expected = {}
    for k in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1]), start=1):
            expected[r[2]] = n
    assert {r.i: r.row_no for r in got} == expected


def test_row_numbers_of_equal_rows(spark):
    got = number_rows(spark.range(2000).select(F.lit("same").alias("v")), ["v"]).collect()
    assert sorted(r.row_no for r in got) == list(range(1, 2001))

