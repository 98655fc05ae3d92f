"""Exact duration statistics from histograms of whole milliseconds.

The statistics are shown in whole milliseconds, and truncation keeps the order
of values, so the n-th smallest millisecond is the millisecond of the n-th
smallest value. Rows therefore collapse into a histogram on the map side; no
task ever sorts the values of a group, however hot the group is.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafspark.storage import written_table

# A block spans 4096 milliseconds and thus holds at most 4096 histogram cells.
_BLOCK_BITS = 12

# Longer values would not fit a long in nanoseconds.
_LONGEST_S = 9.0e9

# The quantiles shown next to the median.
QUANTILES = {"q95_ms": 0.95, "q99_ms": 0.99}

STATISTICS = ["mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms"]


def whole_and_rest(seconds: Column) -> tuple[Column, Column]:
    """Whole milliseconds, and the nanoseconds beyond them; null for what is no duration.

    Null, NaN and values of more than 9 billion seconds, infinite ones included, are no durations.
    """
    good = F.abs(seconds) <= _LONGEST_S
    ms = F.when(good, (seconds * 1000.0).cast("bigint"))
    return ms, F.when(good, F.floor(seconds * 1e9 + 0.5) - ms * 1_000_000)


def duration_histogram(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``(by, ms, n, rest_ns)``: counts per whole millisecond, and nanoseconds beyond them for the mean."""
    ms, rest = whole_and_rest(F.col(value).cast("double"))
    cells = df.select(*by, ms.alias("ms"), rest.alias("rest_ns")).where(F.col("ms").isNotNull())
    return cells.groupBy(*by, "ms").agg(F.count("*").alias("n"), F.sum("rest_ns").alias("rest_ns"))


def _rank(total: Column, quantile: float) -> Column:
    """0-based rank in single precision, as the statistics define it."""
    return (total.cast("float") * F.lit(quantile).cast("float")).cast("bigint")


def _same_group(by: list[str]) -> Column:
    """Equal keys, null keys included, of rows and of rows with renamed keys."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by], F.lit(True))


def statistics_of_histogram(histogram: DataFrame, by: list[str]) -> DataFrame:
    """``(by, n, mean_ms, q50_ms, q95_ms, q99_ms, max_ms)`` of a stored table ``(by, ms, n, rest_ns)``.

    A group's window sees one row of sums for each 4096 ms of its value range. Only the blocks that hold
    a rank, three at most, meet their cells again. A millisecond may have several cells.
    """
    cells = histogram.select(*by, "ms", "n", "rest_ns", F.shiftright("ms", _BLOCK_BITS).alias("block"))
    in_block = F.col("ms") - F.shiftleft("block", _BLOCK_BITS)
    blocks = cells.groupBy(*by, "block").agg(
        F.sum("n").alias("block_n"),
        F.sum(in_block * F.col("n")).alias("block_ms"),
        F.sum("rest_ns").alias("block_rest"),
        F.max("ms").alias("block_max"),
    )
    group = Window.partitionBy(*by)
    earlier = group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("total", F.sum("block_n").over(group)).withColumn(
        "before", F.coalesce(F.sum("block_n").over(earlier), F.lit(0))
    )
    total = F.col("total")
    ranks = [F.floor(total / 2), *[_rank(total, quantile) for quantile in QUANTILES.values()]]
    # one block holds a rank
    held = []
    for which, rank in enumerate(ranks):
        here = rank - F.col("before")
        inside = (here >= 0) & (here < F.col("block_n"))
        held.append(F.max(F.when(inside, F.struct(F.lit(which).alias("which"), F.col("block").alias("_block"), here.alias("rank")))))
    # sums are exact, in decimals where they may exceed a long, so the mean does not depend on the order of rows
    wide = "decimal(20,0)"
    block_start = F.shiftleft("block", _BLOCK_BITS).cast(wide) * F.col("block_n").cast(wide)
    all_ms = F.sum(block_start) + F.sum(F.col("block_ms").cast(wide))
    nanos = all_ms.cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)") + F.sum(F.col("block_rest").cast(wide))
    mean = nanos.cast("double") / 1e9 / F.sum("block_n") * 1000.0
    # the three ranks of a group go with its sums to the cells of their blocks
    sums = placed.groupBy(*by).agg(
        F.sum("block_n").alias("total"), mean.cast("bigint").alias("mean_ms"), F.max("block_max").alias("max_ms"),
        F.array(*held).alias("held"),
    )
    held = sums.where(F.col("total") > 0).select(*[F.col(k).alias(f"_of_{k}") for k in by], "total", "mean_ms", "max_ms", F.inline("held"))
    near = cells.join(held, _same_group(by) & (F.col("block") == F.col("_block")))
    near = near.repartition(*by) if by else near.repartition(1)
    found = near.withColumn("seen", F.sum("n").over(Window.partitionBy(*by, "which").orderBy("ms")))
    reached = F.col("seen") > F.col("rank")
    names = ["q50_ms", *QUANTILES]
    picked = {name: F.min(F.when(reached & (F.col("which") == i), F.col("ms"))) for i, name in enumerate(names)}
    carried = {"n": F.max("total"), "mean_ms": F.max("mean_ms"), "max_ms": F.max("max_ms")}
    both = {**carried, **picked}
    stats = found.groupBy(*by).agg(*[both[name].alias(name) for name in ["n", *STATISTICS]])
    if by:
        return stats
    return stats.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in stats.columns])


def duration_stats(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean, median, 95 % and 99 % nearest rank and maximum of seconds, in whole milliseconds.

    What is no duration, such as null and NaN, is left out. Without ``by`` an empty input gives zeros. The input is
    read once, when this is called, and its histogram stored.
    """
    by = by or []
    return statistics_of_histogram(written_table(duration_histogram(df, value, by), "durations"), by)


def duration_columns(df: DataFrame, values: list[str], by: list[str]) -> DataFrame:
    """Statistics of several columns in one pass, one row per group and ``metric``."""
    pairs = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])
    long = df.select(*by, F.inline(pairs))
    return duration_stats(long, "value", [*by, "metric"])
