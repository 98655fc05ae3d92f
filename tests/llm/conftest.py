import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Stores rows as a Parquet table and reads it again."""

    def store(rows, schema):
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def documents(stored):
    """A table of documents from texts; every other column has something in it."""

    def make(texts, ids=None, sources=None, schema=DOCS):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources, strict=True)]
        return stored(rows, schema)

    return make


@pytest.fixture(scope="session")
def odd_documents(stored):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns that operators add themselves."""
    long_text = " ".join(f"word{i % 977} the{i % 13}" for i in range(120_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta", "en", "b", 35),
        (1, "Alpha beta gamma delta epsilon zeta", "en", "b", 35),
        (1, "another text under the same key", "de", "a", 31),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "ALPHA BETA GAMMA DELTA EPSILON ZETA", "fr", None, 35),
        (None, None, None, None, None),
        (7, long_text, "en", "a", len(long_text)),
        (8, "x" * 200_000, "en", "c", 200_000),
        (9, " \t\n ", "es", "c", 4),
        (10, "naïve Straße 東京 😀 É token = 'abcdefghijklmnop' <|endoftext|> end", "en", "c", 60),
    ]
    schema = T.StructType([*DOCS.fields, T.StructField("score", T.StringType()), T.StructField("row", T.IntegerType())])
    return stored([(*r, "own", n) for n, r in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def no_documents(stored):
    return stored([], DOCS)
