"""Entries of very large bundle files, each file read by many tasks.

A file is scanned in splits, in pieces that end with a closing brace. Whether a piece begins inside a string, and how
deep it is nested, depends on all text before it; but what a piece, and so a split, does to that state is known from
its own text for both cases. So splits are scanned at the same time, their effects are put together, and only then the
pieces are judged.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafspark.schemas import ENTRY_TEXT
from sheafspark.sources.exact_json import read_exact
from sheafspark.storage import written_table

_RUNNING = "STRUCT<no: BIGINT, inside: BIGINT, depth_outside: BIGINT, depth_inside: BIGINT>"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _effects(value: Column) -> list[Column]:
    """Quotes of a piece, and how the depth changes over it if it begins outside or inside a string."""
    # an escape never spans two pieces: a brace cannot be escaped
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    quotes = _count(plain, '"')
    columns = [quotes.alias("quotes")]
    for begins, text in ((0, plain), (1, F.concat(F.lit('"'), plain))):
        outside = F.regexp_replace(text, r'"[^"]*+(?:"|\z)', "")
        closed = ((quotes + begins) % 2 == 0).cast("int")  # the brace itself is outside
        columns.append((_count(outside, "{[") - _count(outside, "]") - closed).alias(f"change_{begins}"))
    return columns


def _running(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Number, state and depth of pieces in their split, for a split that begins outside or inside a string.

    ``inside`` and the depths are those behind a piece, relative to the split. A task holds whole splits in order.
    """
    split, before = None, np.zeros(4, np.int64)
    for files, starts, *numbers in columns:
        out = np.zeros((len(files), 4), np.int64)
        if len(files):
            quotes, *changes = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in numbers)
            keys = list(zip(files.to_pylist(), starts.to_pylist(), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for first, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[first] != split:
                    split, before = keys[first], np.zeros(4, np.int64)
                part = slice(first, stop)
                after = before[1] + np.cumsum(quotes[part])
                inside = (after - quotes[part]) % 2
                own = np.where(inside, changes[1][part], changes[0][part]), np.where(inside, changes[0][part], changes[1][part])
                out[part] = np.stack(
                    [before[0] + 1 + np.arange(stop - first), after % 2, before[2] + np.cumsum(own[0]), before[3] + np.cumsum(own[1])], 1
                )
                before = out[stop - 1]
        names = ["no", "inside", "depth_outside", "depth_inside"]
        yield pa.StructArray.from_arrays([pa.array(out[:, i]) for i in range(4)], names)


def _splits(pieces: DataFrame) -> DataFrame:
    """The state in which each split begins, and whether its file is whole. A few rows a file."""
    last = pieces.groupBy("file", "split_start", "file_bytes").agg(
        F.max_by(F.struct("inside", "depth_outside", "depth_inside"), "no").alias("end"), F.sum(F.col("bytes") + 1).alias("size")
    )
    file = Window.partitionBy("file").orderBy("split_start")
    earlier, all_rows = file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    begins = F.coalesce(F.sum("end.inside").over(earlier), F.lit(0)) % 2
    last = last.withColumn("begins_inside", begins)
    change = F.when(F.col("begins_inside") == 1, F.col("end.depth_inside")).otherwise(F.col("end.depth_outside"))
    last = last.withColumn("change", change).withColumn("begins_at", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    # the last piece of a file may have no brace at its end
    open_end = (F.sum("size").over(all_rows) - F.col("file_bytes")).cast("int")
    whole = (F.sum("change").over(all_rows) + open_end == 0) & (F.sum("end.inside").over(all_rows) % 2 == 0)
    return last.select(
        F.col("file").alias("of_file"), F.col("split_start").alias("of_start"), "begins_inside", "begins_at", whole.alias("whole")
    )


# what stands before the first brace outside of strings
_HEAD = r'^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)\{'


def read_large_entries(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``(file, entry_no, entry)``: the objects in the ``entry`` list of each bundle file, as text that is written.

    Every file is split like other text, so one bundle of any size is read by many tasks; an entry itself fits a row.
    ``entry_no`` counts objects from 0. A file whose strings or brackets do not close has one row without entry. Files are
    uncompressed. Pieces are stored with their place when this is called; after that each piece moves to its neighbours
    of the split and then to the rest of its entry.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "}")
    meta = {"file": "file_path", "split_start": "file_block_start", "file_bytes": "file_size"}
    lines = reader.text(path).select(
        *[F.col(f"_metadata.{name}").alias(alias) for alias, name in meta.items()],
        F.octet_length("value").cast("bigint").alias("bytes"),
        "value",
        *_effects(F.col("value")),
    )
    state = F.arrow_udf(_running, _RUNNING)("file", "split_start", "quotes", "change_0", "change_1")
    pieces = written_table(lines.select("*", state.alias("state")).select(*meta, "bytes", "value", "state.*"), "json-pieces")
    splits = written_table(_splits(pieces), "json-splits")
    placed = pieces.join(splits, (F.col("file") == F.col("of_file")) & (F.col("split_start") == F.col("of_start")))
    begins_inside = F.col("begins_inside") == 1
    depth = F.col("begins_at") + F.when(begins_inside, F.col("depth_inside")).otherwise(F.col("depth_outside"))
    ends = ((F.col("begins_inside") + F.col("inside")) % 2 == 0) & (depth <= 2)
    placed = placed.where("whole").select("file", "split_start", "no", "value", F.when(ends, depth).alias("ends_at"))

    # records end where an object of the root, or of a list of the root, closes
    split = Window.partitionBy("file", "split_start")
    before = F.count("ends_at").over(split.orderBy("no").rowsBetween(Window.unboundedPreceding, -1))
    numbered = placed.withColumn("record_in_split", before)
    counts = placed.groupBy("file", "split_start").agg(F.count("ends_at").alias("records"))
    earlier = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("file", "split_start", F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("records_before"))
    numbered = numbered.join(counts, ["file", "split_start"])
    record = (F.col("records_before") + F.col("record_in_split")).alias("record_no")
    piece = F.struct("split_start", "no", "value").alias("piece")
    records = numbered.select("file", record, piece, "ends_at").groupBy("file", "record_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["value"]), "}").alias("text"),
        F.max("ends_at").alias("ends_at"),
    )
    text = F.when(F.col("record_no") == 0, F.regexp_replace("text", r"^\s*+\{", "")).otherwise(F.col("text"))
    head = F.regexp_extract(F.concat(text, F.lit("{")), _HEAD, 1)
    records = records.where("ends_at = 2").select("file", "record_no", text.alias("text"), head.alias("head"))
    # the list that a record begins; records that go on in a list have a comma only
    key = F.regexp_extract("head", r'"((?:[^"\\]++|\\.)*+)"\s*+:\s*+\[\s*+(?:null\s*+,\s*+)*+$', 1)
    key = F.when(~F.col("head").rlike(r"^\s*+,(?:\s*+null\s*+,)*+\s*+$"), key)
    records = written_table(records.select("file", "record_no", "text", F.length("head").alias("head_chars"), key.alias("key")), "json-records")
    # one row for each list of a bundle's root that holds objects
    lists = records.where("key IS NOT NULL").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("record_no", "key"))).alias("lists"))
    listed = records.join(lists, "file")
    own = F.element_at(F.filter("lists", lambda x: x["record_no"] <= F.col("record_no")), -1)
    found = listed.withColumn("own", own).where("own.key = 'entry'").select(
        "file",
        (F.col("record_no") - F.col("own.record_no")).alias("entry_no"),
        F.concat(F.expr("substring(text, head_chars + 1)"), F.lit("}")).alias("entry"),
    )
    none = splits.where("NOT whole").select(F.col("of_file").alias("file"), F.lit(None).cast("bigint"), F.lit(None).cast("string")).distinct()
    return found.unionAll(none)


def large_file_entries(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``(file, entry, corrupt)`` for ``route_file_entries``: one row an entry, resources as exact text.

    ``entry`` is a list of one; an entry that cannot be read, or a file that is not whole, is a row with ``corrupt``.
    """
    entries = read_large_entries(spark, path, pattern)
    element = ENTRY_TEXT.removeprefix("ARRAY<STRUCT<").removesuffix(">>")
    read = read_exact(entries, "entry", element, "large-entries")
    broken = F.when(F.col("parsed").isNull(), F.lit("unreadable"))
    return read.select("file", F.col("entry_no").alias("file_entry_no"), F.array("parsed").alias("entry"), broken.alias("corrupt"))
