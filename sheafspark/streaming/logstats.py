"""Running statistics of a request log.

What is kept is a histogram of whole milliseconds with counts and byte sums. It grows with the range of latencies, not
with the log, and still yields exact nearest-rank statistics. Each batch adds the cells of its own rows; cells of several
batches are summed up into fewer, larger tables from time to time.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.operators.logstats import log_cells
from sheafspark.storage import delete_path, path_exists

#: Tables of one level that are summed up into one of the next.
FAN_IN = 8
_KEYS = ("metric", "class", "status", "ms")
_SUMS = ("n", "rest_ns", "bytes_in", "bytes_out")


class Part(NamedTuple):
    """A table with the cells of some batches, in a folder below the target."""

    level: int
    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"cells-{self.level}-{self.first}-{self.last}"


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _read(spark: SparkSession, target: str, parts: list[Part]) -> DataFrame:
    return spark.read.parquet(*[f"{target}/{p.folder}" for p in parts])


def _lists(spark: SparkSession, target: str) -> dict[int, list[Part]]:
    """The tables that count after each of the last batches; a few rows."""
    if not path_exists(spark, f"{target}/lists"):
        return {}
    rows = spark.read.schema("level int, first long, last long, batch long").json(f"{target}/lists").collect()
    found: dict[int, list[Part]] = {}
    for row in sorted(rows, key=lambda r: r.first):
        found.setdefault(row.batch, []).append(Part(row.level, row.first, row.last))
    return found


def add_batch(log: DataFrame, batch: int, target: str) -> None:
    """Adds the cells of a batch; a batch that comes again after a crash replaces what it left.

    Written are the cells of the batch, and from time to time those of the ``FAN_IN`` last tables of a level as one; so a
    cell is written again once a level. A list of the tables that count is written last, so nobody reads half a batch.
    Tables and lists that neither this list nor the one before names are deleted.
    """
    spark = log.sparkSession
    lists = {n: parts for n, parts in _lists(spark, target).items() if n < batch}
    before = lists.get(max(lists, default=-1), [])
    own = Part(0, batch, batch)
    log_cells(log).write.mode("overwrite").parquet(f"{target}/{own.folder}")
    parts, made = [*before, own], [own]
    while len(same := [p for p in parts if p.level == parts[-1].level]) >= FAN_IN:
        merged = Part(same[0].level + 1, same[0].first, same[-1].last)
        _summed(_read(spark, target, same)).write.mode("overwrite").parquet(f"{target}/{merged.folder}")
        parts, made = [p for p in parts if p not in same] + [merged], [*made, merged]
    rows = spark.createDataFrame([tuple(p) for p in parts], "level int, first long, last long").coalesce(1)
    rows.write.mode("overwrite").json(f"{target}/lists/batch={batch}")
    # the list before this one stays readable, for readers under way and for a repeated batch
    old = sorted(lists)[:-1]
    for part in {*made, *(p for n in old for p in lists[n])} - {*parts, *before}:
        delete_path(spark, f"{target}/{part.folder}")
    for n in old:
        delete_path(spark, f"{target}/lists/batch={n}")


def run_upload_stats(log_stream: DataFrame, target: str, checkpoint: str):
    """Keeps the cells of all requests so far below ``target``, see ``add_batch``; ``read_cells`` has them."""
    return (
        log_stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda log, batch: add_batch(log, batch, target))
        .trigger(availableNow=True)
        .start()
    )


def read_cells(spark: SparkSession, target: str) -> DataFrame:
    """The cells after the last batch that was written as a whole."""
    lists = _lists(spark, target)
    return _summed(_read(spark, target, lists[max(lists)]))
