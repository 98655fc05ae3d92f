"""Writing resources and building bundles."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafspark.functions.json_text import compact_json
from sheafspark.operators.numbering import number_rows, sliced_rows
from sheafspark.sources.chunks import locate_lines
from sheafspark.storage import path_exists


def export_ndjson(df: DataFrame, path: str, resource: str = "resource", order_by: list[str] | None = None) -> None:
    """One compact resource per line in a new directory of part files; fails if the path exists.

    Rows without a resource give no line.
    With ``order_by`` the parts, read in name order, hold the rows in that order.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    lines = df.select(compact_json(F.col(resource)).alias(resource)).where(F.col(resource).isNotNull())
    lines.write.mode("errorifexists").text(path)


#: Below an ordered export: its parts in order. Readers of text pass over the name.
MANIFEST = "_manifest"


def export_ordered(df: DataFrame, path: str, order_by: list[str], resource: str = "resource") -> None:
    """Like ``export_ndjson`` with an order, and a list of the parts that is written last; fails if the path exists.

    The list has a row for each folder ``part=n``: its first and last key, rows, and the bytes it has in the parts one
    behind the other. Without it an export is not whole, and ``read_ordered`` refuses it. Rows are stored in their order
    first, since a second run of the range partitioning could cut the parts elsewhere.
    """
    kept = [c for c in order_by if c != resource]
    lines = df.select(*kept, compact_json(F.col(f"`{resource}`")).alias(resource)).where(F.col(resource).isNotNull())
    stored = sliced_rows(lines, order_by, [])
    part = F.lpad(F.col("_slice").cast("string"), 10, "0").alias("part")
    parts = stored.select(part, "_slice", "_place", resource).repartition("_slice").sortWithinPartitions("part", "_place")
    parts.select("part", resource).write.mode("errorifexists").partitionBy("part").text(path)
    key = F.struct(*order_by)
    listed = stored.groupBy(part).agg(
        F.min_by(key, "_place").alias("first_key"), F.max_by(key, "_place").alias("last_key"),
        F.count("*").alias("rows"), F.sum(F.octet_length(resource) + 1).alias("bytes"),
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    before = {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("rows", "bytes")}
    listed.withColumns(before).write.parquet(f"{path}/{MANIFEST}")


def ordered_parts(spark: SparkSession, path: str) -> DataFrame:
    """The list of an ordered export's parts; an error if the export is not whole."""
    if not path_exists(spark, f"{path}/{MANIFEST}/_SUCCESS"):
        raise ValueError(f"the export to {path} is not whole: it has no list of its parts")
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_ordered(spark: SparkSession, path: str, resource: str = "resource") -> DataFrame:
    """``(row_no, start_bytes, end_bytes, resource)`` of an ordered export, numbered from 1 over all parts."""
    parts = ordered_parts(spark, path).select("part", "rows_before", "bytes_before")
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    located = locate_lines(lines, ["value"]).withColumn("part", F.regexp_extract("file", r"/part=(\d+)/[^/]*$", 1))
    return located.join(parts, "part").select(
        (F.col("chunk_no") + F.col("rows_before")).alias("row_no"),
        *[(F.col(c) + F.col("bytes_before")).alias(c) for c in ("start_bytes", "end_bytes")],
        F.col("value").alias(resource),
    )


def _string(text: Column) -> Column:
    """The text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def post_entry(resource: Column, url: Column) -> Column:
    """Bundle entry that carries a resource as written."""
    return F.concat(
        F.lit('{"resource":'), resource, F.lit(',"request":{"method":"POST","url":'), _string(url), F.lit("}}")
    )


def count_entry(resource_type: Column) -> Column:
    """Bundle entry that asks for the number of resources of a type."""
    return F.concat(
        F.lit('{"request":{"method":"GET","url":'), _string(F.concat(resource_type, F.lit("?_summary=count"))), F.lit("}}")
    )


def assemble_bundles(
    df: DataFrame, keys: list[str], position: str, entry: str, bundle_type: str = "batch", more: list[Column] | None = None
) -> DataFrame:
    """One bundle text per key with its entries by position; rows without an entry are left out.

    ``more`` are further aggregates of the same rows.
    The keys must bound the entries per bundle; ``make_bundles`` derives such keys.
    """
    entries = F.array_sort(F.collect_list(F.struct(position, entry)))
    return df.where(F.col(entry).isNotNull()).groupBy(*keys).agg(
        F.concat(
            F.lit(f'{{"resourceType":"Bundle","type":"{bundle_type}","entry":['),
            F.array_join(F.transform(entries, lambda e: e[entry]), ","),
            F.lit("]}"),
        ).alias("bundle"),
        F.count("*").alias("entries"),
        *(more or []),
    )


def make_bundles(
    df: DataFrame, entry: str, order_by: list[str], size: int, keys: list[str] | None = None, bundle_type: str = "batch"
) -> DataFrame:
    """``(keys, bundle_no, bundle, entries)``, ``size`` entries per bundle in the given order.

    Rows without an entry are left out before they are numbered.
    """
    keys = keys or []
    numbered = number_rows(df.where(F.col(entry).isNotNull()).select(*dict.fromkeys([*keys, *order_by, entry])), order_by, keys)
    placed = numbered.withColumn("bundle_no", F.floor((F.col("row_no") - 1) / size))
    return assemble_bundles(placed, [*keys, "bundle_no"], "row_no", entry, bundle_type)
