"""Landed result pages and capability documents."""

from pyspark.sql import DataFrame, SparkSession

from sheafspark.schemas import CAPABILITIES, PAGES


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """One row per page: url, status, link header, body, timing and size."""
    return spark.read.format(format).schema(PAGES).load(path)


def read_capabilities(spark: SparkSession, path: str) -> DataFrame:
    """One row per capability document, one document per file."""
    return spark.read.schema(CAPABILITIES).json(path, multiLine=True)
