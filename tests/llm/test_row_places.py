"""Rows keep their place when a later scan splits the files in another way."""

import random

import pytest

from sheafspark.llm.mixing import mix
from sheafspark.llm.row_places import placed
from sheafspark.llm.simhash import simhash_survivors

SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")


@pytest.fixture
def many_groups(spark, tmp_path):
    """A table of 3 files with many row groups."""
    chance = random.Random(1)
    rows = [(i, f"s{i % 5}", " ".join(chance.choices("abcdefghij", k=3 + i % 40))) for i in range(3000)]
    rows += [(i, "s1", rows[7][2]) for i in range(3000, 3500)]
    folder = str(tmp_path / "docs.parquet")
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    frame.write.option("parquet.block.size", 4096).option("parquet.page.row.count.limit", 50).parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture
def other_splits(spark):
    before = {name: spark.conf.get(name, None) for name in SPLITS}

    def change():
        for name, value in zip(SPLITS, ("8k", "1", "60"), strict=True):
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_splits_differ(many_groups, other_splits):
    before = many_groups.rdd.getNumPartitions()
    other_splits()
    assert many_groups.select("doc_id").rdd.getNumPartitions() > 2 * before


def test_mix(many_groups, other_splits):
    plain = sorted(map(tuple, mix(many_groups).collect()))
    again = mix(many_groups)
    other_splits()
    assert sorted(map(tuple, again.collect())) == plain
    assert len(plain) == 3500 and all(r[3] == len(r[2].split()) for r in plain)


def test_survivors(many_groups, other_splits):
    plain = sorted(r.doc_id for r in simhash_survivors(many_groups).collect())
    again = simhash_survivors(many_groups)
    other_splits()
    assert sorted(r.doc_id for r in again.collect()) == plain
    assert 7 in plain and not set(range(3000, 3500)) & set(plain)


def test_a_table_that_is_not_stored_is_stored(spark):
    rows, place = placed(spark.createDataFrame([(i,) for i in range(10)], "doc_id long"))
    assert rows.select(place).distinct().count() == 10
