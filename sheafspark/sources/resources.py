"""Resources landed once with their text and a decoded form, for searches by paths."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The column with the decoded resource.
DOCUMENT = "document"


def land_resources(df: DataFrame, path: str, resource: str = "resource") -> None:
    """Writes the rows as Parquet with ``document``, the resource as ``VARIANT``; null where it is no JSON.

    A search by paths then reads the decoded form only, and text stays as it is for exports. Fails if the path exists.
    """
    df.withColumn(DOCUMENT, F.try_parse_json(F.col(resource))).write.mode("errorifexists").parquet(path)


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
