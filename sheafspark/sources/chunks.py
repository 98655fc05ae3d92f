"""Byte ranges of delimiter-separated chunks in files and text columns."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafspark.storage import written_table

_SPAN = "ARRAY<STRUCT<chunk_no: BIGINT, start_bytes: BIGINT, end_bytes: BIGINT>>"


_PLACE = "STRUCT<no_in_block: BIGINT, start_in_block: BIGINT>"


def _places(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Numbers lines and adds up bytes inside each file split; one task holds whole splits in order."""
    file, block, lines, offset = None, None, 0, 0
    for files, blocks, sizes in columns:
        if len(sizes) == 0:
            yield pa.array([], pa.struct([("no_in_block", pa.int64()), ("start_in_block", pa.int64())]))
            continue
        size = sizes.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        starts_split = np.ones(len(size), dtype=bool)
        starts_split[0] = files[0].as_py() != file or blocks[0].as_py() != block
        same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(blocks[1:], blocks[:-1]))
        starts_split[1:] = ~same.to_numpy(zero_copy_only=False)

        row = np.arange(len(size))
        before = np.cumsum(size) - size
        first = np.maximum.accumulate(np.where(starts_split, row, -1))
        continued = first < 0
        no = np.where(continued, row + lines, row - first)
        start = np.where(continued, before + offset, before - before[first])

        file, block = files[-1].as_py(), blocks[-1].as_py()
        lines, offset = int(no[-1]) + 1, int(start[-1] + size[-1])
        yield pa.StructArray.from_arrays([pa.array(no, pa.int64()), pa.array(start, pa.int64())], ["no_in_block", "start_in_block"])


def _with_block(lines, keep):
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.octet_length("value").cast("bigint").alias("bytes"),
        *keep,
    )


def _numbered(rows):
    """Adds the place of each line in its split; only names, numbers and lengths leave the JVM."""
    place = F.arrow_udf(_places, _PLACE)(F.col("file"), F.col("block_start"), F.col("bytes"))
    return rows.select("*", place.alias("place")).select(*rows.columns, "place.*")


def _block_offsets(rows):
    """Lines and bytes of each file before each of its splits."""
    totals = rows.groupBy("file", "block_start").agg(
        F.count("*").alias("lines"), F.sum(F.col("bytes") + 1).alias("size")
    )
    earlier = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        F.col("file").alias("block_file"),
        F.col("block_start").alias("block_at"),
        F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("lines_before"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("bytes_before"),
    )


def locate_lines(lines: DataFrame, keep: list[str]) -> DataFrame:
    """``(file, chunk_no, start_bytes, end_bytes, keep)`` of each row of a text scan.

    One scan: lines are stored with their place in the split, and the totals of splits come from there.
    """
    numbered = written_table(_numbered(_with_block(lines, keep)), "lines")
    blocks = written_table(_block_offsets(numbered), "line-blocks")
    joined = numbered.join(
        blocks, (F.col("file") == F.col("block_file")) & (F.col("block_start") == F.col("block_at"))
    )
    start = F.col("bytes_before") + F.col("start_in_block")
    return joined.select(
        "file",
        (F.col("lines_before") + F.col("no_in_block") + 1).alias("chunk_no"),
        start.alias("start_bytes"),
        (start + F.col("bytes")).alias("end_bytes"),
        *keep,
    )


def chunk_index(spark: SparkSession, path: str, delimiter: str = "\n", pattern: str = "*") -> DataFrame:
    """``(file, chunk_no, start_bytes, end_bytes)`` of all chunks, empty ones included."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", delimiter)
        .text(path)
    )
    return locate_lines(lines, [])


def _spans(texts, delimiter):
    """List array of the chunks of each text."""
    texts = texts.cast(pa.large_string())
    count = len(texts)
    if count == 0:
        return pa.array([], pa.list_(pa.struct([(n, pa.int64()) for n in ("chunk_no", "start_bytes", "end_bytes")])))
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + count + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    cuts = np.flatnonzero(content[at[0] : at[-1]] == delimiter) + at[0]
    first, last = np.searchsorted(cuts, at[:-1]), np.searchsorted(cuts, at[1:])
    closed = last - first
    length = np.diff(at)
    rest_from = np.where(closed > 0, np.append(cuts, 0)[last - 1] + 1 - at[:-1], 0)
    chunks = closed + (length > rest_from)

    ends = np.cumsum(chunks)
    row = np.repeat(np.arange(count), chunks)
    no = np.arange(ends[-1]) - (ends - chunks)[row]
    cut = np.append(cuts, 0)
    end = np.where(no < closed[row], cut[first[row] + np.minimum(no, closed[row])] - at[row], length[row])
    start = np.where(no > 0, cut[first[row] + no - 1] + 1 - at[row], 0)
    spans = pa.StructArray.from_arrays(
        [pa.array(no + 1, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
        names=["chunk_no", "start_bytes", "end_bytes"],
    )
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), spans)


def split_chunks(df: DataFrame, text: str, delimiter: str = "\n") -> DataFrame:
    """One row per chunk of a text column, with number and byte range inside the text."""
    code = ord(delimiter)
    if code > 127:
        raise ValueError("the delimiter must be a single byte")

    @F.arrow_udf(_SPAN)
    def spans(texts: pa.Array) -> pa.Array:
        return _spans(texts, code)

    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.explode(spans(F.col(text))).alias("span")).select(*keep, "span.*")
