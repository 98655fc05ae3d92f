"""Approximate nearest neighbours by cosine: randomly rotated one-bit codes with error bounds, then exact scores."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafspark.storage import scratch_path, written_table

#: Rows that the centres are fitted on, whatever the size of the table, and the centres.
SAMPLE_ROWS = 4_096
CENTRES = 16
#: Width of the error bounds: an estimate misses by more than this many standard deviations for few vectors.
EPSILON = 2.2
#: Queries that are searched in one pass over the codes, and what a task compares at a time.
BLOCK_QUERIES = 16_384
SLICE_QUERIES, SLICE_ROWS, SLICE_PAIRS = 512, 2_048, 1 << 15
_SEED = 20_240_521
#: Estimates are in single precision.
_ROUNDING = 1e-5


def takes_part(vector: Column) -> Column:
    """Not null, no component null or not finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled up with zeros, each scaled by a power of two that keeps its square finite."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), width))
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, initial=0))[1][:, None])


def lengths(points: np.ndarray) -> np.ndarray:
    return np.sqrt((points**2).sum(1))


def cosines(a: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Row by row; equal rows have equal cosines wherever they stand."""
    return (a * b).sum(1) / (a_length * b_length)


@dataclass
class Codes:
    """The rotation and the centres that all codes of a table share.

    A vector of length 1 is c + r u, with the nearest centre c and u of length 1. Its code has one bit for each component
    of u in the rotated space: the sign. The corner of the cube that the signs name, scaled to length 1, has an inner
    product a with u, and for a query q the product of corner and q - c, divided by a, estimates that of u and q - c.
    The rotation is random, so the estimate misses by at most e |q - c| sqrt((1 - a^2) / a^2) / sqrt(dim - 1) but for a
    small probability that e sets.
    """

    width: int
    centres: np.ndarray

    def __post_init__(self):
        self.dim = max(8, -(-self.width // 8) * 8)
        gauss = np.random.default_rng(_SEED).normal(size=(self.dim, self.dim))
        q, r = np.linalg.qr(gauss)
        self.rotation = q * np.sign(np.diag(r))

    def turned(self, points: np.ndarray) -> np.ndarray:
        return points @ self.rotation[: self.width]

    def encode(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, the number of the centre, and the scalars base, slope and wide of each vector of length 1.

        q * vector is about q * c + base + slope * (q * corner), give or take wide * |q - c|.
        """
        centre = (points @ self.centres.T - (self.centres**2).sum(1) / 2).argmax(1)
        own = self.centres[centre]
        rest = points - own
        radius = lengths(rest)
        turned = self.turned(rest)
        bits = turned > 0
        corner = np.where(bits, 1.0, -1.0) / np.sqrt(self.dim)
        # the share of the rest that its corner keeps; nothing is left to estimate for a vector on its centre
        kept = np.where(radius > 0, (turned * corner).sum(1) / np.where(radius > 0, radius, 1), 1.0)
        slope = radius / kept
        base = (rest * own).sum(1) - slope * (corner * self.turned(own)).sum(1)
        wide = slope * np.sqrt(np.maximum(0, 1 - kept**2) / (self.dim - 1))
        return np.packbits(bits, axis=1), centre, base, slope, wide

    def corners(self, packed: np.ndarray) -> np.ndarray:
        return (np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(self.dim))


def fit_codes(sample: np.ndarray, width: int, centres: int = CENTRES) -> Codes:
    """Codes with centres fitted on a sample of vectors of length 1: a few rounds of nearest centres and their means."""
    chosen = sample[np.random.default_rng(_SEED).permutation(len(sample))[:centres]]
    for _ in range(8):
        own = (sample @ chosen.T - (chosen**2).sum(1) / 2).argmax(1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(chosen))[:, None]
        chosen = np.where(n > 0, sums / np.maximum(n, 1), chosen)
    return Codes(width, chosen)


class Best:
    """The k highest exact scores found so far for each query of a block; the least of them is what others must reach."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.row_id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.floor = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, row_id: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        query, row_id = np.append(self.query, query), np.append(self.row_id, row_id)
        score = np.append(self.score, score)
        order = np.lexsort((row_id, -score, query))
        query, row_id, score = query[order], row_id[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        full = place == self.k - 1
        self.floor[query[full]] = score[full]
        self.query, self.row_id, self.score = (x[place < self.k] for x in (query, row_id, score))


class Search:
    """A block of queries against slices of encoded rows, inside a task."""

    def __init__(self, codes: Codes, ids: np.ndarray, points: np.ndarray, k: int, epsilon: float):
        order = np.argsort(ids, kind="stable")
        self.codes, self.k, self.epsilon = codes, k, epsilon
        self.ids, self.points = ids[order], points[order]
        self.length = lengths(self.points)
        unit = self.points / self.length[:, None]
        self.turned = codes.turned(unit).astype(np.float32)
        self.to_centre = (unit @ codes.centres.T).astype(np.float32)
        away = 1 + (codes.centres**2).sum(1)[None, :] - 2 * (unit @ codes.centres.T)
        self.away = np.sqrt(np.maximum(away, 0)).astype(np.float32)
        self.best = Best(len(ids), k)
        self.compared = 0

    def _score(self, query: np.ndarray, row: np.ndarray, ids, points, length) -> None:
        for start in range(0, len(query), SLICE_PAIRS):
            q, r = query[start : start + SLICE_PAIRS], row[start : start + SLICE_PAIRS]
            self.compared += len(q)
            self.best.add(q, ids[r], cosines(self.points[q], self.length[q], points[r], length[r]))

    def rows(self, ids: np.ndarray, points: np.ndarray, packed: np.ndarray, centre, base, slope, wide) -> None:
        length, corners = lengths(points), self.codes.corners(packed)
        base, slope = base.astype(np.float32), slope.astype(np.float32)
        wide = (self.epsilon * wide).astype(np.float32)
        for start in range(0, len(self.ids), SLICE_QUERIES):
            part = slice(start, start + SLICE_QUERIES)
            guess = self.to_centre[part][:, centre] + base + slope * (self.turned[part] @ corners.T)
            most = guess + wide * self.away[part][:, centre] + np.float32(_ROUNDING)
            # a query's own rows are no candidates
            left, right = (np.searchsorted(self.ids[part], ids, side) for side in ("left", "right"))
            for row in np.flatnonzero(left < right):
                most[left[row] : right[row], row] = -np.inf
            if self.k < len(ids):  # the best guesses first: they raise what the others must reach
                row = np.argpartition(-np.where(np.isinf(most), -np.inf, guess), self.k - 1, axis=1)[:, : self.k]
                query = np.repeat(np.arange(len(most)), self.k)
                row = row.ravel()
                good = most[query, row] >= self.best.floor[part][query]
                self._score(query[good] + start, row[good], ids, points, length)
                most[query[good], row[good]] = -np.inf
            query, row = np.nonzero((most >= self.best.floor[part][:, None]) & ~np.isinf(most))
            self._score(query + start, row, ids, points, length)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        best = self.best
        return self.ids[best.query], best.query, best.row_id, best.score


def encoded(rows: DataFrame, codes: Codes) -> DataFrame:
    """Adds code, centre, base, slope and wide to rows (id, v)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column(1), codes.width)
                packed, centre, *scalars = codes.encode(points / lengths(points)[:, None])
                packed = pa.array([p.tobytes() for p in packed], pa.binary())
                more = [packed, pa.array(centre.astype(np.int32)), *map(pa.array, scalars)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["id", "v", "code", "centre", "base", "slope", "wide"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id long, v {kind}, code binary, centre int, base double, slope double, wide double")


def approximate_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", epsilon: float = EPSILON
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` rows with the largest cosine that the codes lead to.

    Queries are rows of ``vectors`` for which ``is_query`` holds; candidates are all rows with another key, repeated ones
    each. Ties go to the smaller key. The score is the cosine of the original vectors in double precision. Rows with a
    null key take no part, nor do vectors that are null, zero, or hold a component that is null or not finite. Shorter
    vectors are filled up with zeros. Queries that agree in key and vector are one. With fewer candidates all are
    returned; an empty table or no query gives an empty table.

    Every row is encoded. A row's exact score is computed for a query if its estimate and error bound could reach the
    k-th best score that the task has found for the query so far; nothing else is left out, and no number of candidates is
    capped. ``epsilon`` is the width of the bounds. Centres of the codes come from ``SAMPLE_ROWS`` rows, chosen by a hash.

    Queries pass over the stored codes in blocks of about ``BLOCK_QUERIES``, sent to all tasks; rows stay where they are,
    and only the k best of each query and task are shuffled.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & takes_part(F.col("v")))
    spark = rows.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    asked = rows.where("q").select("id", "v").distinct()
    asked = written_table(asked, "asked")
    facts = rows.agg(F.max(F.size("v")).alias("width")).first()
    queries = asked.count()
    if not queries:
        return spark.createDataFrame([], result)
    width = facts.width
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE_ROWS).toArrow()
    points = matrix(sample.column("v").combine_chunks(), width)
    codes = fit_codes(points / lengths(points)[:, None], width)
    index = written_table(encoded(rows.select("id", "v"), codes), "bit-codes")

    blocks = -(-queries // BLOCK_QUERIES)
    by_block = scratch_path(spark, "query-blocks")
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block")
    asked.select("id", "v", block).repartition("block").write.partitionBy("block").parquet(by_block)
    folder = scratch_path(spark, "neighbours")
    for n in range(blocks):
        of_block = spark.read.schema(f"id long, v {asked.schema['v'].dataType.simpleString()}, block long").parquet(by_block)
        held = of_block.where(F.col("block") == n).select("id", "v").toArrow()  # a block, not the queries
        if held.num_rows:
            _block(index, codes, held, k, epsilon).write.parquet(f"{folder}/block={n}")
    return spark.read.schema(f"{result}, block long").parquet(folder).drop("block")


def _block(index: DataFrame, codes: Codes, held: pa.Table, k: int, epsilon: float) -> DataFrame:
    """The k best of a block of queries over the whole index."""
    ids, points = held.column("id").to_numpy(), matrix(held.column("v").combine_chunks(), codes.width)
    # plain values: executors need no installed copy of the class
    sent = index.sparkSession.sparkContext.broadcast((codes.width, codes.centres, ids, points))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, centres, ids, points = sent.value
        search = Search(Codes(width, centres), ids, points, k, epsilon)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                packed = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                scalars = [part.column(i).to_numpy() for i in (3, 4, 5, 6)]
                search.rows(part.column(0).to_numpy(), matrix(part.column(1), width), packed, *scalars)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in search.found()], ["query_id", "no", "vec_id", "score"])

    found = index.mapInArrow(search, "query_id long, no long, vec_id long, score double")
    order = Window.partitionBy("query_id", "no").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
