"""One bundle file read by many tasks, against the JSON reader of Python."""

import json
import random

import pytest

from sheafspark.operators.unbundle import route_file_entries, split_kinds
from sheafspark.sources.large_json import large_file_entries, read_large_entries

SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def splits_of(spark):
    before = {name: spark.conf.get(name, None) for name in SPLITS}

    def change(size):
        for name, value in zip(SPLITS, (size, "1"), strict=True):
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def value(chance, levels):
    kind = chance.random()
    if levels == 0 or kind < 0.3:
        return chance.choice([1, None, True, "a}b", '"{[', "\\", '\\"}', "é}", 1.5, "", "]"])
    if kind < 0.6:
        return [value(chance, levels - 1) for _ in range(chance.randint(0, 3))]
    return {chance.choice(["a", "b}", "entry", '"x']): value(chance, levels - 1) for _ in range(chance.randint(0, 3))}


def fill(folder, chance):
    """Bundles with entries under strange neighbours; the expected entries by file name, None for a broken file."""
    wanted = {}
    for n in range(8):
        entries = [{"resource": value(chance, 3)} if chance.random() < 0.9 else {} for _ in range(chance.choice([0, 1, 5, 25]))]
        items = {
            "meta": {"x": {"y": [{"a": 1}]}}, "link": [{"relation": "self", "url": "}"}], "total": 3, "entry": entries,
            "z": [{"q": 1}], "w": {"entry": [{"no": 1}]}, "n": [None, 1, [{"entry": 2}]],
        }
        order = list(items.items())
        chance.shuffle(order)
        text = json.dumps(dict(order), indent=chance.choice([None, 1]), ensure_ascii=chance.random() < 0.5)
        text = text[:-1] if n == 6 else text + '"' if n == 7 else text + "\n" * (n % 3)
        (folder / f"f{n}.json").write_text(text)
        wanted[f"f{n}.json"] = None if n in (6, 7) else entries
    return wanted


@pytest.mark.parametrize("size", ["128m", "1k"])
def test_entries_equal_the_reader(spark, tmp_path, splits_of, size):
    wanted = fill(tmp_path, random.Random(1))
    splits_of(size)
    entries = read_large_entries(spark, str(tmp_path))
    splits_of("128m")
    got = {name: [] for name in wanted}
    for r in entries.collect():
        got[r.file.rsplit("/", 1)[1]].append((r.entry_no, r.entry))
    for name, own in wanted.items():
        found = sorted(got[name])
        if own is None:
            assert found == [(None, None)]
        else:
            assert [n for n, _ in found] == list(range(len(own)))
            assert [json.loads(e) for _, e in found] == own


def test_a_file_of_many_splits_keeps_its_text(spark, tmp_path, splits_of):
    entry = '{"resource": {"resourceType": "Patient", "n": 1.50, "t": "}\\"{%d"}}'
    outcome = '{"resource": {"resourceType": "OperationOutcome", "issue": []}, "search": {"mode": "outcome"}}'
    listed = [entry % n for n in range(20_000)] + [outcome, '{"search": 5}']
    (tmp_path / "one.json").write_text('{"resourceType": "Bundle", "entry": [' + ",\n".join(listed) + "]}")
    splits_of("100k")
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 10
    found = split_kinds(route_file_entries(large_file_entries(spark, str(tmp_path))))
    resources = {r.file_entry_no: r.resource for r in found.resources.collect()}
    assert resources == {n: f'{{"resourceType":"Patient","n":1.50,"t":"}}\\"{{{n}"}}' for n in range(20_000)}
    assert (found.outcomes.count(), found.malformed.count()) == (1, 1)


def test_no_files_and_empty_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "bare.json").write_text("{}")
    (tmp_path / "white.json").write_text(" \n")
    assert read_large_entries(spark, str(tmp_path)).collect() == []
