"""Bundles and resources as streams."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.operators.unbundle import route_entries
from sheafspark.schemas import PAGES
from sheafspark.sources.bundles import MULTI_PATTERN


def stream_bundles(spark: SparkSession, path: str, pattern: str = MULTI_PATTERN, files_per_trigger: int | None = None) -> DataFrame:
    """``(file, value)`` of the non-empty lines of files as they appear below a directory."""
    reader = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value").where(F.octet_length("value") > 0)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages as they appear."""
    return spark.readStream.schema(PAGES).parquet(path)


def run_unbundle(stream: DataFrame, path: str, checkpoint: str, body: str = "body", exact: bool = True):
    """Writes ``route_entries`` of each page as it arrives: resources, outcomes and malformed pages in one pass.

    Each batch of the stream has a folder ``batch=n`` with subfolders by ``kind``; a repeated batch writes its folder again.
    """

    def add(pages, batch):
        routed = route_entries(pages, body, exact)
        routed.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch={batch}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(availableNow=True).start()
