"""Key/value metric reports with labels and aligned lines."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Metric names and their labels in display order.
METRIC_LABELS = {
    "seq-write-throughput": "Seq. Write Throughput",
    "read-iops": "Read IOPS",
    "read-throughput": "Read Throughput",
    "read-latency-p50": "Read Latency (p50)",
    "read-latency-p95": "Read Latency (p95)",
    "read-latency-p99": "Read Latency (p99)",
    "read-latency-max": "Read Latency (max)",
    "fsync-rate": "Fsync Rate",
    "fsync-latency-p50": "Fsync Latency (p50)",
    "fsync-latency-p95": "Fsync Latency (p95)",
    "fsync-latency-p99": "Fsync Latency (p99)",
    "direct-io": "Direct I/O",
    "score": "Score",
    "rating": "Rating",
    "processing-duration": "Processing Duration",
}

# Unlabelled parameters follow the labels in their own order.
_AFTER_LABELS = 1 << 40


def _join_same(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """All rows with the columns of the lookup row that has the same keys; null keys are equal."""
    same = lookup.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    return rows.join(same, match, "left").drop(*[f"_same_{k}" for k in keys])


def label_params(params: DataFrame, labels: dict[str, str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Adds ``label`` and ``place`` to ``(keys, pos, name, …)`` rows.

    The first parameter with a known name takes the label and its place; all
    others, later ones of a known name included, follow under their raw name.
    """
    labels = METRIC_LABELS if labels is None else labels
    keys = keys or []
    numbers = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)])
    texts = F.create_map(*[F.lit(x) for item in labels.items() for x in item])
    firsts = (
        params.where(F.col("name").isin(list(labels)))
        .groupBy(*keys, "name")
        .agg(F.min("pos").alias("pos"))
        .withColumn("_labelled", F.lit(True))
    )
    # the position is part of the join key, so a name that repeats a lot is no hot key
    joined = _join_same(params, firsts, [*keys, "name", "pos"])
    return joined.select(
        *params.columns,
        F.when(F.col("_labelled"), texts[F.col("name")]).otherwise(F.col("name")).alias("label"),
        F.when(F.col("_labelled"), numbers[F.col("name")].cast("bigint"))
        .otherwise(F.col("pos") + _AFTER_LABELS)
        .alias("place"),
    )


def render_metrics(labelled: DataFrame, value: str = "value", keys: list[str] | None = None) -> DataFrame:
    """``(keys, place, line)``: labels padded to the widest of the report, two spaces, the value.

    The widest label is the one with most bytes; padding counts characters.
    """
    keys = keys or []
    width = F.max(F.octet_length("label")).alias("_width")
    if keys:
        rows = _join_same(labelled, labelled.groupBy(*keys).agg(width), keys)
    else:
        rows = labelled.withColumn("_width", labelled.agg(width).scalar())
    line = F.concat(F.rpad("label", F.col("_width"), F.lit(" ")), F.lit("  "), F.col(value))
    return rows.select(*keys, "place", line.alias("line"))
