"""A pipeline over ``documents`` in stages; every stage reads what the one before has written.

Stage functions take (spark, docs, sf_dir), where ``docs`` is a stored table, and return a DataFrame.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafspark.llm.queries import pipeline_bpe, pipeline_exact_dedup, pipeline_mixing, pipeline_simhash, pipeline_toxicity
from sheafspark.storage import written_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", pipeline_toxicity),
    ("exact dedup", pipeline_exact_dedup),
    ("simhash near-dedup", pipeline_simhash),
    ("mixing", pipeline_mixing),
    ("bpe", pipeline_bpe),
]

#: SQL has neither the classifier nor the fingerprints and encodings of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``, each result written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = written_table(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
