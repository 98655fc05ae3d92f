"""Tables written between stages.

Operators that read an intermediate result more than once, or that iterate,
write it to the shared folder the cluster names in ``spark.checkpoint.dir``
and read it back. Nothing is written to a machine's own temporary folder. That cuts the lineage, survives the loss of executors and
freezes values such as partition ids that a second run could assign anew.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one in the session's warehouse.

    A warehouse on a local disk serves a local session only: on a cluster every machine would see its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {folder} is local to each")
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, path)
    return files.exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and returns the stored table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
