"""Dense row numbers and running sums without a window over a whole key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafspark.storage import written_table


def sliced_rows(df: DataFrame, order_by: list[str], keys: list[str]) -> DataFrame:
    """Stores the rows range-partitioned by key and order, with ``_slice`` and ``_place``.

    A hot key spreads over many slices. The table is stored because a second run
    of the range partitioning could cut the slices elsewhere.
    """
    # arrival spreads rows that agree in all order columns
    ranges = [*keys, *order_by, "_arrival"]
    sliced = (
        df.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(*ranges)
        .sortWithinPartitions(*ranges)
        .drop("_arrival")
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return written_table(sliced, "sliced-rows")


def _with_heads(stored, heads, keys):
    """Joins one row per key and slice to the rows.

    There are at most as many heads as keys and slices together. They are stored, so the engine
    knows their size; slices are bounded, so no join key is hot.
    """
    heads = heads.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_slice").alias("_head_slice"), "_shift"
    )
    heads = written_table(heads, "slice-heads")
    match = F.col("_slice") == F.col("_head_slice")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return stored.join(heads, match)


def _earlier_slices(keys):
    return Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, order_by: list[str], keys: list[str] | None = None) -> DataFrame:
    """Adds ``row_no``, 1-based in the given order inside each key."""
    keys = keys or []
    stored = sliced_rows(df, order_by, keys)
    heads = stored.groupBy(*keys, "_slice").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = F.coalesce(F.sum("_rows").over(_earlier_slices(keys)), F.lit(0))
    heads = heads.withColumn("_shift", before - F.col("_first"))
    return _with_heads(stored, heads, keys).select(
        *df.columns, (F.col("_place") + F.col("_shift") + 1).alias("row_no")
    )

