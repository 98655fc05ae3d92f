import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafspark.functions.metrics import fmt_quantity
from sheafspark.functions.text import (
    duration_text,
    fmt_bytes,
    fmt_duration,
    fmt_ratio,
    indent,
    indent_except_first,
    ratio,
    success_ratio,
    two_decimals,
)
from sheafspark.functions.urls import encode_query, parse_query, query_is_valid
from sheafspark.functions.versions import version_older


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_durations(spark):
    cases = [
        (7, "7ms"), (999, "999ms"), (4040, "4.04s"), (7003, "7.003s"), (9000, "9s"), (120000, "2m0s"),
        (185000, "3m5s"), (1510000, "25m10s"), (7200000, "2h0m0s"), (0, "0s"), (181499, "3m1s"), (181500, "3m2s"), (59998, "59.998s"),
    ]
    got = values(spark, [(c[0],) for c in cases], "ms BIGINT", fmt_duration(F.col("ms")))
    assert got == [c[1] for c in cases]
    exact = values(spark, [(62500,), (-1500,), (3661001,)], "ms BIGINT", duration_text(F.col("ms")))
    assert exact == ["1m2.5s", "-1.5s", "1h1m1.001s"]


def test_bytes(spark):
    cases = [
        (0.0, "0.00 B"), (1024.0, "1024.00 B"), (1025.0, "1.00 KiB"), (5767168.0, "5.50 MiB"),
        (5.0 * 1024**6, "5120.00 PiB"), (1024.0**2, "1024.00 KiB"), (0.125, "0.12 B"), (0.375, "0.38 B"), (None, None),
    ]
    got = values(spark, [(c[0],) for c in cases], "b DOUBLE", fmt_bytes(F.col("b")))
    assert got == [c[1] for c in cases]


def test_two_decimals_rounds_like_exact_binary(spark):
    rng = random.Random(5)
    numbers = [k / 8 for k in range(200)] + [1.005, 2.675, 99.995, 0.0, 5e-7, 123456.785, -2.125, 3e9]
    numbers = [float(np.float32(n)) for n in numbers + [rng.expovariate(0.01) for _ in range(2000)]]
    got = values(spark, [(n,) for n in numbers], "n DOUBLE", two_decimals(F.col("n")))
    assert got == [f"{n:.2f}" for n in numbers]


def test_indentation(spark):
    assert values(spark, [("a\nb",)], "t STRING", indent(2, F.col("t"))) == ["  a\n  b"]
    assert values(spark, [("a\nb",)], "t STRING", indent_except_first(2, F.col("t"))) == ["a\n  b"]


def test_ratios(spark):
    rows = [(45, 100), (1, 3), (5, 0)]
    percent = ratio(F.col("n"), F.col("d"))
    assert values(spark, rows, "n INT, d INT", fmt_ratio(percent)) == ["45.00 %", "33.33 %", None]
    share = success_ratio(F.col("t"), F.col("a"), F.col("b"))
    assert values(spark, [(8, 1, 1), (0, 0, 0)], "t INT, a INT, b INT", share) == [75.0, None]


@pytest.mark.parametrize(
    "version, older",
    [
        ("1.10.1", True), ("1.11.0", False), ("1.12.3", False), ("unknown", False), (None, False), ("1", True),
        ("1.11", False), ("1.11.0-rc.1", True), ("1.11.0+build.5", False), ("01.2.3", False), ("1.9.99", True),
        ("1.11.0-", False), ("0.99999999999999999999.0", True),
    ],
)
def test_versions(spark, version, older):
    assert values(spark, [(version,)], "v STRING", version_older(F.col("v"), "1.11.0")) == [older]


def test_prerelease_order(spark):
    # public precedence example of semantic versioning
    ordered = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc.1", "1.0.0"]
    for low, high in zip(ordered, ordered[1:]):
        assert values(spark, [(low,), (high,)], "v STRING", version_older(F.col("v"), high)) == [True, False]


def test_queries(spark):
    rows = [("a=1&b=x%20y+z&a=2&&c&=d&e=f=g",)]
    parsed = values(spark, rows, "q STRING", parse_query(F.col("q")))[0]
    assert [tuple(p) for p in parsed] == [("a", "1"), ("b", "x y z"), ("a", "2"), ("c", ""), ("", "d"), ("e", "f=g")]
    bad = [("a=%zz",), ("a=1;b=2",), ("a=1",)]
    assert values(spark, bad, "q STRING", query_is_valid(parse_query(F.col("q")))) == [False, False, True]
    text = values(spark, [("z=1&b=~*&a= é&z=0",)], "q STRING", encode_query(parse_query(F.col("q"))))
    assert text == ["a=+%C3%A9&b=~%2A&z=1&z=0"]


def test_quantities(spark):
    rows = [
        ("868220928", None, "By/s", "828.00 MiB/s"), ("210", "x", "us", "210 µs"), ("85000", None, "/s", "85000/s"),
        ("65.20", "s", None, "65.20 s"), ("7", None, None, "7"), (None, "s", None, " s"), ("fast", None, "By/s", "fast B/s"),
    ]
    quantity = fmt_quantity(F.col("v"), F.col("u"), F.col("c"))
    assert values(spark, [r[:3] for r in rows], "v STRING, u STRING, c STRING", quantity) == [r[3] for r in rows]
