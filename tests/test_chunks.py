import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafspark.sources.bundles import read_ndjson_bundles
from sheafspark.sources.chunks import _spans, chunk_index, split_chunks

CASES = [
    ("first\nsecond one\n", [(0, 5), (6, 16)]),
    ("cut\noff", [(0, 3), (4, 7)]),
    ("one line\n", [(0, 8)]),
    ("one line", [(0, 8)]),
    ("a\n\n\n\nb", [(0, 1), (2, 2), (3, 3), (4, 4), (5, 6)]),
    ("", []),
    ("é\nü", [(0, 2), (3, 5)]),
]


def chunks_of(text, delimiter="\n"):
    """Byte ranges by walking through the text."""
    data, found, start = text.encode(), [], 0
    for i, byte in enumerate(data):
        if byte == ord(delimiter):
            found.append((start, i))
            start = i + 1
    if start < len(data):
        found.append((start, len(data)))
    return found


@pytest.mark.parametrize("text, expected", CASES)
def test_text_column(spark, text, expected):
    assert chunks_of(text) == expected
    rows = split_chunks(spark.createDataFrame([(1, text)], "id INT, text STRING"), "text").orderBy("chunk_no").collect()
    assert [(r.start_bytes, r.end_bytes) for r in rows] == expected
    assert [r.chunk_no for r in rows] == list(range(1, len(expected) + 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="a\n;é", max_size=12)), max_size=8), st.sampled_from("\n;a"))
def test_spans_match_a_walk(texts, delimiter):
    got = _spans(pa.array(texts, pa.string()), ord(delimiter)).to_pylist()
    expected = [chunks_of(t or "", delimiter) for t in texts]
    assert [[(c["start_bytes"], c["end_bytes"]) for c in row] for row in got] == expected


def test_spans_of_a_slice():
    texts = pa.array(["x\ny", "a\n\nb", "c"]).slice(1)
    assert [len(row) for row in _spans(texts, 10).to_pylist()] == [3, 1]


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of 64 bytes, several of which share a task."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "1")
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def write(folder, texts):
    for name, text in texts.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as out:
            out.write(text.encode())


def long_texts():
    lines = [("x" * (i * 7 % 90)) + ("é" * (i % 3)) + ("\r" if i % 5 == 0 else "") for i in range(300)]
    return {
        "a.ndjson": "\n".join(lines) + "\n",
        "sub/b.ndjson": "\n".join(lines[::-1]),
        "c.ndjson": "\n\n\n",
        "d.ndjson": "",
    }


def test_files_over_many_splits(spark, tmp_path, small_splits):
    texts = long_texts()
    write(tmp_path, texts)
    rows = chunk_index(spark, str(tmp_path)).collect()
    for name, text in texts.items():
        mine = sorted((r.chunk_no, r.start_bytes, r.end_bytes) for r in rows if r.file.endswith("/" + name))
        assert mine == [(i + 1, s, e) for i, (s, e) in enumerate(chunks_of(text))]


def test_other_delimiter(spark, tmp_path, small_splits):
    write(tmp_path, {"a.txt": "one;two;;three\nfour;" * 20})
    rows = chunk_index(spark, str(tmp_path), ";").collect()
    got = sorted((r.start_bytes, r.end_bytes) for r in rows)
    assert got == sorted(chunks_of("one;two;;three\nfour;" * 20, ";"))


def test_ndjson_bundles(spark, tmp_path, small_splits):
    texts = long_texts()
    write(tmp_path, texts)
    rows = read_ndjson_bundles(spark, str(tmp_path)).collect()
    for name, text in texts.items():
        data = text.encode()
        expected = [
            (i + 1, s, e, data[s:e].decode()) for i, (s, e) in enumerate(chunks_of(text)) if e > s
        ]
        mine = sorted((r.bundle_no, r.start_bytes, r.end_bytes, r.value) for r in rows if r.file.endswith("/" + name))
        assert mine == expected



def test_offsets_of_broken_utf8_are_those_of_the_bytes(spark, tmp_path):
    """Lines that are no UTF-8: the text source hands out their bytes as they are."""
    rng = random.Random(4)
    lines = [bytes(rng.choice(b"ab\xff\xc3\xe9\x80\r ") for _ in range(rng.randrange(40))) for _ in range(3000)]
    content = b"\n".join(lines)
    (tmp_path / "latin.ndjson").write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = chunk_index(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    at, wanted = 0, []
    for n, line in enumerate(content.split(b"\n"), start=1):
        wanted.append((n, at, at + len(line)))
        at += len(line) + 1
    if wanted[-1][1] == wanted[-1][2]:
        wanted.pop()  # nothing behind the last delimiter
    assert sorted((r.chunk_no, r.start_bytes, r.end_bytes) for r in rows) == wanted
    read = read_ndjson_bundles(spark, str(tmp_path)).select("start_bytes", F.hex("value").alias("bytes")).collect()
    assert {r.start_bytes: bytes.fromhex(r.bytes) for r in read} == {a: content[a:b] for _, a, b in wanted if a < b}
