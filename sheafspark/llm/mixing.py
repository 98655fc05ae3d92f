"""Mixing sources to target weights by balanced sampling (the cube method)."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sheafspark.llm.arrow_text import byte_column, each
from sheafspark.llm.row_places import placed
from sheafspark.operators.numbering import number_rows
from sheafspark.storage import written_table

WEIGHTS = (5.0, 2.0, 1.0)
#: No source gives more than so many times its size, and so no document.
MOST = 3.0
#: Documents of a block that one flight balances.
BLOCK_ROWS = 5_000
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""

    @F.arrow_udf("long")
    def words(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in each(columns):
            yield pa.array([len(t.as_buffer().to_pybytes().split()) for t in byte_column(texts)], pa.int64())

    return words(text)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, rows, target) for a stored table (source, source_size, rows) with one row a source.

    Sources in code point order, null last, have the weights in turn and share the total of all sizes; a target stops
    at ``most`` times its source's size and what is above goes to the others by weight, until none is above.
    """
    ordered = number_rows(sizes.withColumn("without", F.col("source").isNull()), ["without", "source"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("row_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = written_table(ordered.select("source", "source_size", "rows", weight.alias("weight")), "sources")
    total = table.agg(F.sum("source_size").alias("t")).first().t or 0
    level, capped = None, -1
    cap = F.col("source_size") * most
    while True:  # the share of a weight of 1 only grows, and with it the sources that stop
        above = F.lit(False) if level is None else F.col("weight") * level > cap
        now = table.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(above).alias("capped"),
        ).first()
        if now.capped == capped or not now.open:
            break
        level, capped = (total - now.fixed) / now.open, now.capped
    share = F.lit(0.0) if level is None else F.least(F.col("weight") * level, cap)
    return table.select("source", "source_size", "rows", share.cast("double").alias("target"))


class Flight:
    """Moves probabilities along the null space of two constraints: the number of rows and their total size.

    At most two rows stay open between steps. A third one makes a direction in which both totals keep still; the step
    goes to one of its two ends, by chance and so that the expected probabilities keep still as well, and decides a row.

    Rows come with the largest first. Open rows land when much smaller ones follow: they are decided by chance, and
    what that misses in size is moved to rows that follow. ``taken`` and ``left`` are about the size that rows to come
    will take and leave; a row lands only where they can make up for it.
    """

    def __init__(self, seed: int, taken: float = np.inf, left: float = np.inf):
        self.chance = np.random.default_rng(seed & (2**63 - 1))
        self.taken, self.left, self.missing = taken, left, 0.0
        self.open: list[list] = []  # row, probability, size

    def _land(self) -> list[tuple[int, float]]:
        decided = []
        for row, p, size in self.open:
            ends = {v: self.missing + (p - v) * size for v in (0.0, 1.0)}
            over = {v: max(0.0, -e - max(0.0, self.taken), e - max(0.0, self.left)) for v, e in ends.items()}
            value = float(self.chance.random() < p)
            if over[value] > over[1 - value]:
                value = 1 - value
            self.missing = ends[value]
            decided.append((row, value))
        self.open = []
        return decided

    def add(self, row: int, probability: float, size: float, landing: bool = True) -> list[tuple[int, float]]:
        """Takes a row; returns the decided ones with their probability, 0 or 1."""
        decided = []
        self.taken -= probability * size
        self.left -= (1 - probability) * size
        if landing and probability > _EPS:
            if self.open and size < max(x[2] for x in self.open) / 2:
                decided = self._land()
            if self.missing:
                moved = min(1.0, max(0.0, probability + self.missing / size))
                self.missing -= (moved - probability) * size
                probability = moved
        if probability < _EPS or probability > 1 - _EPS:
            return [*decided, (row, float(round(probability)))]
        self.open.append([row, probability, size])
        while len(self.open) > 2 or (len(self.open) == 2 and self.open[0][2] == self.open[1][2]):
            p = [x[1] for x in self.open]
            s = [x[2] for x in self.open]
            move = [1.0, -1.0] if len(p) == 2 else [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
            if not any(move):
                move = [1.0, -1.0, 0.0]
            up = min((1 - a if m > 0 else a) / abs(m) for a, m in zip(p, move, strict=True) if m)
            down = min((a if m > 0 else 1 - a) / abs(m) for a, m in zip(p, move, strict=True) if m)
            step = up if self.chance.random() * (up + down) < down else -down
            rest = []
            for x, m in zip(self.open, move, strict=True):
                x[1] += step * m
                if x[1] < _EPS or x[1] > 1 - _EPS:
                    decided.append((x[0], float(round(x[1]))))
                else:
                    rest.append(x)
            self.open = rest
        return decided


def _fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``decided`` to rows (block, n, size, probability, taken, left, ...) that are sorted by block.

    Texts do not come here: what a task holds are numbers.
    """
    block, flight, held = None, None, {}

    def with_column(batch, values):
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, "decided"])

    number = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        found = np.full(batch.num_rows, np.nan)
        first = number
        columns = (batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5))
        for i, (own, size, p, taken, left) in enumerate(zip(*columns, strict=True)):
            if own != block:
                for row, value in _settled(flight):
                    if row >= first:
                        found[row - first] = value
                    else:
                        yield with_column(held.pop(row), [value])
                block, flight = own, Flight(own, taken, left)
            for row, value in flight.add(number, p, float(size)):
                if row >= first:
                    found[row - first] = value
                else:
                    yield with_column(held.pop(row), [value])
            number += 1
        done = ~np.isnan(found)
        for i in np.flatnonzero(~done):  # two rows at most
            held[first + int(i)] = batch.slice(int(i), 1)
        if done.any():
            yield with_column(batch.filter(pa.array(done)), found[done])
    for row, value in _settled(flight):
        yield with_column(held.pop(row), [value])


def _settled(flight: Flight | None) -> list[tuple[int, float]]:
    """The open rows of a block that ends, landed where the total size is met best."""
    if flight is None:
        return []
    options: list[list[tuple[int, float]]] = [[]]
    for row, _, _ in flight.open:
        options = [[*o, (row, v)] for o in options for v in (0.0, 1.0)]

    def miss(option):
        both = list(zip(option, flight.open, strict=True))
        return abs(sum((v - p) * s for (_, v), (_, p, s) in both) - flight.missing), abs(sum(v - p for (_, v), (_, p, _) in both))

    return min(options, key=miss)


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds size, source_size, target and copies to every row of ``docs``, a stored table.

    Size counts words. ``copies`` is how often the mix takes the row: the whole part of target / source_size, and one
    more for a sample with the rest as inclusion probability, which keeps the number and total size of the taken rows
    of each source near their expectation. Each source is cut into blocks that fly and land by themselves; a
    block misses its total by less than its smallest rows where those can make up for the others. Rows are told apart by source, size, key and order, so reruns agree.
    Null texts have size 0 and are taken 0 times; null sources are one source, the last; null keys are keys like others.
    An empty table gives an empty table. Columns of the four names are replaced. Without ``keep_text`` the text column
    is left out, and only sizes are shuffled.
    """
    own = ("size", "source_size", "target", "copies")
    columns = [c for c in docs.columns if c not in own and (keep_text or c != text)]
    docs, place = placed(docs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        place.alias("id"),
        F.col(f"`{source}`").alias("source"),
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
    )
    sized = written_table(rows.select("id", "source", "key", word_count(F.col("text")).alias("size")), "sized")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(written_table(by_source, "source-sizes"))
    targets = written_table(targets.withColumn("source_no", F.xxhash64("source", F.col("source").isNull())), "source-targets")
    ready = sized.join(targets, sized.source.eqNullSafe(targets.source))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rest = expected - F.floor(expected)
    # rows of a source are dealt to its blocks by a hash, and fly there with the largest first
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS).cast("long")
    place = F.xxhash64("source_no", "key", "size")
    whole = F.when(F.col("size") > 0, F.floor(expected)).otherwise(0).cast("int")
    dealt = (
        ready.select(
            F.xxhash64("source_no", F.pmod(place, blocks)).alias("block"),
            place.alias("n"),
            "size",
            F.when(F.col("size") > 0, rest).otherwise(0.0).alias("probability"),
            (rest * F.col("source_size") / blocks).alias("taken"),
            ((1 - rest) * F.col("source_size") / blocks).alias("left"),
            "id",
            "source_size",
            "target",
            whole.alias("whole"),
        )
        .repartition("block")
        .sortWithinPartitions("block", F.desc("size"), "n", "id")
    )
    flown = dealt.mapInArrow(_fly, StructType([*dealt.schema.fields, StructField("decided", DoubleType())]))
    copies = (F.col("whole") + F.col("decided").cast("int")).alias("copies")
    taken = written_table(flown.select("id", "size", "source_size", "target", copies), "mix")
    # whole rows move in the same way at every size
    return rows.select("row", "id").join(taken.hint("merge"), "id").select(
        *[F.col("row")[c].alias(c) for c in columns], "size", "source_size", "target", "copies"
    )
