"""Exact deduplication: a first pass finds possibly repeated hashes, and only those rows are shuffled."""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import byte_column, each
from sheafspark.storage import written_table

#: Bits of the filter for each row, and the most words of 64 bits that a filter has (64 MB for each of two planes).
BITS_PER_ROW = 16
MAX_WORDS = 1 << 23
#: Words of the filter that travel in one row.
SEGMENT_WORDS = 1 << 14
_BITS = 5


def _digests(texts: pa.Array) -> pa.Array:
    """SHA-256 of each text with A-Z lower-cased, as 32 bytes; null counts as empty."""
    # bytes.lower() changes A-Z only
    found = [hashlib.sha256(t.as_buffer().to_pybytes().lower()).digest() for t in byte_column(texts)]
    return pa.array(found, pa.binary())


def _places(hashes: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter word of each hash, and its bits there."""
    raw = np.frombuffer(b"".join(hashes.to_pylist()), np.uint64).reshape(-1, 4)
    mask = np.zeros(len(raw), np.uint64)
    for k in range(_BITS):
        mask |= np.uint64(1) << ((raw[:, 1] >> np.uint64(6 * k)) & np.uint64(63))
    return (raw[:, 0] % np.uint64(words)).astype(np.int64), mask


class RepeatFilter:
    """Two Bloom filters: bits that some row has set, and bits that two rows have set."""

    def __init__(self, words: int):
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, hashes: pa.Array) -> None:
        at, mask = _places(hashes, len(self.once))
        order = np.lexsort((mask, at))
        at, mask = at[order], mask[order]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1]) | (mask[1:] != mask[:-1])
        for place, bits in set(zip(at[~first].tolist(), mask[~first].tolist(), strict=True)):
            self.twice[place] |= np.uint64(bits)
        at, mask = at[first], mask[first]
        while len(at):  # of different hashes in one word, one after the other
            now = np.append(True, at[1:] != at[:-1])
            self.twice[at[now]] |= self.once[at[now]] & mask[now]
            self.once[at[now]] |= mask[now]
            at, mask = at[~now], mask[~now]

    def merge(self, start: int, once: np.ndarray, twice: np.ndarray) -> None:
        own = slice(start, start + len(once))
        self.twice[own] |= twice | (self.once[own] & once)
        self.once[own] |= once


def repeat_filter(texts: DataFrame, words: int) -> np.ndarray:
    """The second filter's bits over the hashes of all texts, the only column. Each task builds its own pair of filters.

    What the driver gets is at most ``MAX_WORDS`` words, whatever the number of rows.
    """
    spark = texts.sparkSession
    segment = min(SEGMENT_WORDS, words)
    schema = "segment long, once binary, twice binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = RepeatFilter(words)
        for batch in each(batches):
            own.add(_digests(batch.column(0)))
        for start in range(0, words, segment):
            once, twice = (x[start : start + segment] for x in (own.once, own.twice))
            if once.any():
                row = [[start], [zlib.compress(once.tobytes(), 1)], [zlib.compress(twice.tobytes(), 1)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[0], pa.int64()), *(pa.array(x, pa.binary()) for x in row[1:])], ["segment", "once", "twice"]
                )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(start, own):
            return pa.RecordBatch.from_arrays(
                [pa.array([start], pa.int64()), pa.array([zlib.compress(own.twice.tobytes(), 1)], pa.binary())],
                ["segment", "twice"],
            )

        current, own = None, None
        for batch in batches:
            for start, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if start != current:
                    if own is not None:
                        yield out(current, own)
                    current, own = start, RepeatFilter(segment)
                once, twice = (np.frombuffer(zlib.decompress(x), np.uint64) for x in (once, twice))
                own.merge(0, once, twice)
        if own is not None:
            yield out(current, own)

    tasks = max(1, spark.sparkContext.defaultParallelism)
    built = texts.coalesce(tasks).mapInArrow(build, schema)
    merged = built.repartition("segment").sortWithinPartitions("segment").mapInArrow(combine, "segment long, twice binary")
    bits = np.zeros(words, np.uint64)
    for row in merged.collect():
        part = np.frombuffer(zlib.decompress(row.twice), np.uint64)
        bits[row.segment : row.segment + len(part)] = part[: words - row.segment]
    return bits


def _hashed(text: Column, bits: Broadcast) -> Column:
    """Struct of ``sha`` and of ``repeated``, which is false only for hashes of one row. One worker does both."""

    @F.arrow_udf("struct<sha: binary, repeated: boolean>")
    def test(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        twice = bits.value
        for texts in each(columns):
            hashes = _digests(texts)
            at, mask = _places(hashes, len(twice))
            yield pa.StructArray.from_arrays([hashes, pa.array((twice[at] & mask) == mask)], ["sha", "repeated"])

    return test(text)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds text_sha256, keep_id, group_size and kept to every row of ``docs``, a stored table.

    Rows are equal if their texts are, with A-Z lower-cased; a null text is an empty one. The row with the largest key
    stays, a null key being the smallest; of rows with that key, one. ``keep_id`` is its key, ``group_size`` the number
    of equal rows. Rows whose hash cannot be repeated pass straight through; the others are stored in the shared
    folder, grouped by hash and joined with their group. False positives of the filter only add rows there, so the
    result does not depend on its size. An empty table gives an empty table. Columns of the four names are replaced.
    Without ``keep_text`` the text column is left out.
    """
    spark = docs.sparkSession
    own = ("text_sha256", "keep_id", "group_size", "kept")
    columns = [c for c in docs.columns if c not in own and (keep_text or c != text)]
    rows = docs.count()
    words = max(1, min(MAX_WORDS, rows * BITS_PER_ROW // 64 + 1))
    bits = spark.sparkContext.broadcast(repeat_filter(docs.select(F.col(f"`{text}`")), words))
    tested = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{key}`").alias("key"),
        _hashed(F.col(f"`{text}`"), bits).alias("h"),
    ).select("row", "key", "h.sha", "h.repeated")
    passed = tested.where(~F.col("repeated"))
    # the number tells rows with the same key apart
    again = tested.where("repeated").select("row", "key", "sha", F.monotonically_increasing_id().alias("n"))
    again = written_table(again, "maybe-repeated")
    order = F.struct(F.col("key").isNotNull().alias("has_key"), "key", "n")
    groups = written_table(again.groupBy("sha").agg(F.max(order).alias("top"), F.count("*").alias("size")), "text-groups")
    joined = again.join(groups, "sha").select(
        "row", "sha", F.col("top.key").alias("keep_id"), "size", (F.col("n") == F.col("top.n")).alias("kept")
    )
    single = passed.select("row", "sha", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"))
    return single.unionByName(joined).select(
        *[F.col("row")[c].alias(c) for c in columns],
        F.lower(F.hex("sha")).alias("text_sha256"),
        "keep_id",
        F.col("size").alias("group_size"),
        "kept",
    )
