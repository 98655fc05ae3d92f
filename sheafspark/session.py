"""Session settings for tests and the bench; on a cluster the session comes from the submitter."""

import tempfile

from pyspark.sql import SparkSession


def local_session(cores="*", app="sheafspark", shuffle_partitions=8):
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sheafspark-"))
        # call sites of every column cost more than building it
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
