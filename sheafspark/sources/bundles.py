"""Bundle files as DataFrames: discovery, reading, and byte ranges."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.schemas import ENTRY_TEXT
from sheafspark.sources.chunks import locate_lines

# File name endings of single- and multi-bundle files.
SINGLE_SUFFIXES = [".json", ".json.gz", ".json.bz2"]
MULTI_SUFFIX = ".ndjson"

SINGLE_PATTERN = "*.{json,json.gz,json.bz2}"
MULTI_PATTERN = "*.ndjson"


def _files(reader, pattern):
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def bundle_kind(path):
    """``single``, ``multi`` or null; endings are case-sensitive."""
    single = F.lit(False)
    for suffix in SINGLE_SUFFIXES:
        single = single | path.endswith(suffix)
    return F.when(single, F.lit("single")).when(path.endswith(MULTI_SUFFIX), F.lit("multi"))


def discover_bundles(spark: SparkSession, path: str) -> DataFrame:
    """``(path, kind, length)`` of the bundle files below a directory; no content is read."""
    listed = _files(spark.read.format("binaryFile"), "*.{json,json.gz,json.bz2,ndjson}").load(path)
    return listed.select("path", bundle_kind(F.col("path")).alias("kind"), "length")


def read_single_bundles(spark: SparkSession, path: str, pattern: str = SINGLE_PATTERN) -> DataFrame:
    """One bundle per file; gzip and bzip2 are decompressed by file ending.

    The byte range is that of the file, ``payload_bytes`` that of the decompressed text.
    """
    return _files(spark.read, pattern).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.lit(1).cast("bigint").alias("bundle_no"),
        F.lit(0).cast("bigint").alias("start_bytes"),
        F.col("_metadata.file_size").alias("end_bytes"),
        F.octet_length("value").cast("bigint").alias("payload_bytes"),
        "value",
    )


def read_ndjson_text(spark: SparkSession, path: str, pattern: str = MULTI_PATTERN) -> DataFrame:
    """``(file, value)`` of the non-empty lines, for readers that need no byte ranges."""
    lines = _files(spark.read, pattern).option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value").where(F.octet_length("value") > 0)


def read_ndjson_bundles(spark: SparkSession, path: str, pattern: str = MULTI_PATTERN) -> DataFrame:
    """One bundle per non-empty line with its number and byte range in the file.

    Empty lines count for ``bundle_no``. The text is scanned once and stored with the place of
    each line in its file split.
    """
    lines = _files(spark.read, pattern).option("lineSep", "\n").text(path)
    located = locate_lines(lines, keep=["value"])
    return located.select(
        "file",
        F.col("chunk_no").alias("bundle_no"),
        "start_bytes",
        "end_bytes",
        (F.col("end_bytes") - F.col("start_bytes")).alias("payload_bytes"),
        "value",
    ).where(F.col("payload_bytes") > 0)


def read_bundles(
    spark: SparkSession, path: str, single_pattern: str = SINGLE_PATTERN, multi_pattern: str = MULTI_PATTERN
) -> DataFrame:
    """Single- and multi-bundle files below a directory as one table."""
    single = read_single_bundles(spark, path, single_pattern).withColumn("kind", F.lit("single"))
    multi = read_ndjson_bundles(spark, path, multi_pattern).withColumn("kind", F.lit("multi"))
    return single.unionByName(multi)


def source_summary(bundles: DataFrame) -> DataFrame:
    """Files, bundles and payload bytes per kind of source file."""
    per_file = bundles.groupBy("kind", "file").agg(
        F.count("*").alias("bundles"), F.sum("payload_bytes").alias("bytes")
    )
    return per_file.groupBy("kind").agg(
        F.count("*").alias("files"), F.sum("bundles").alias("bundles"), F.sum("bytes").alias("payload_bytes")
    )


def read_ndjson_entries(spark: SparkSession, path: str, pattern: str = MULTI_PATTERN) -> DataFrame:
    """``(file, entry, corrupt)`` of NDJSON bundles, resources as exact text without Python.

    Spark's JSON reader hands out string fields of a line as written.
    """
    reader = _files(spark.read, pattern).option("lineSep", "\n").option("columnNameOfCorruptRecord", "corrupt")
    rows = reader.schema(f"entry {ENTRY_TEXT}, corrupt STRING").json(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), "entry", "corrupt")
