"""Centroid clustering over whole numbers: the nearest centroid by a tournament of bisectors."""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.storage import written_table

#: Vectors that a task compares at a time.
SLICE_ROWS = 4_096
#: Vectors of a sum that is kept in 64 bits before it goes into a number of any size.
_LONG = 2**63 - 1
#: Doubles hold whole numbers up to here one by one.
_EXACT = 2**53


def usable(vector: Column, width: int) -> Column:
    """Whether a vector has exactly ``width`` components, none null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def whole(column: pa.Array, width: int, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of all components x as doubles, which hold these whole numbers as they are; one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(-1, width)


def _numbers(values: np.ndarray, most: int) -> np.ndarray:
    """Whole numbers in the narrowest type in which results up to ``most`` are exact."""
    if most < _EXACT:
        return values.astype(np.float64)
    if values.dtype == np.float64:
        values = np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)
    return values.astype(np.int64) if most <= _LONG else values


@dataclass
class Bisectors:
    """Normals and thresholds of all pairs of centroids.

    x is nearer to centroid j than to i exactly where normal(i, j) * x > threshold(i, j), with the normal 2 (c_j - c_i)
    and the threshold |c_j|^2 - |c_i|^2. All are whole numbers, so the sign is exact.
    """

    centroids: list[tuple[int, ...]]

    def __post_init__(self):
        width = len(self.centroids[0]) if self.centroids else 0
        self.points = np.array(self.centroids, object).reshape(len(self.centroids), width)
        square = (self.points**2).sum(1)
        self.normals = 2 * (self.points[None, :, :] - self.points[:, None, :])
        self.thresholds = square[None, :] - square[:, None]
        self.largest = max((abs(x) for c in self.centroids for x in c), default=0)
        self.by_type: dict[type, tuple] = {}

    def _typed(self, vectors: np.ndarray):
        """Vectors, centroids, normals and thresholds in a type in which all that follows is exact."""
        size = max(int(np.abs(vectors).max(initial=0)), self.largest, 1)
        most = 8 * vectors.shape[1] * size * size  # above distances, thresholds and normal * x
        x = _numbers(vectors, most)
        kind = x.dtype.type
        if kind not in self.by_type:
            self.by_type[kind] = tuple(v.astype(x.dtype) for v in (self.points, self.normals, self.thresholds))
        return x, *self.by_type[kind]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The number of the nearest centroid of each row, the smaller one of equally near, and the squared distance.

        The winner so far meets the next centroid; it stays unless the sign is positive, so zero favours the smaller
        number. k - 1 tests leave one centroid, whose distance alone is computed.
        """
        x, points, normals, thresholds = self._typed(vectors)
        winner = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            sign = (normals[winner, rival] * x).sum(1) - thresholds[winner, rival]
            winner[sign > 0] = rival
        return winner, [int(d) for d in ((x - points[winner]) ** 2).sum(1)]


def initial_centroids(vectors: DataFrame, k: int, width: int, seed: str) -> list[tuple[int, ...]]:
    """The ``k`` vectors with the smallest sha256 of seed:key; rows of one key by their components, null keys last."""
    rank = F.sha2(F.concat(F.lit(seed + ":"), F.col("key").cast("string")), 256)
    values = F.transform("v", lambda x: x.cast("double"))
    first = vectors.select(rank.alias("rank"), "key", values.alias("v")).orderBy(F.asc_nulls_last("rank"), F.asc_nulls_last("key"), "v")
    rows = first.limit(k).select("v").toArrow().column("v").combine_chunks()
    return [tuple(int(x) for x in row) for row in whole(rows, width)]


def _moved(vectors: DataFrame, centroids: list[tuple[int, ...]], width: int) -> list[tuple[int, ...]]:
    """Centroids after one round: tasks sum up their vectors by cluster, so only k rows a task are shuffled."""
    k = len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        counts, sums = np.zeros(k, np.int64), np.array([[0] * width] * k, object).reshape(k, width)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                x = whole(batch.column(0).slice(start, SLICE_ROWS), width)
                own, _ = bisectors.nearest(x)
                counts += np.bincount(own, minlength=k)
                x = _numbers(x, SLICE_ROWS * int(np.abs(x).max(initial=0)))
                part = np.zeros((k, width), x.dtype)
                np.add.at(part, own, x)
                sums += part.astype(np.int64).astype(object) if part.dtype != object else part
        used = np.flatnonzero(counts)
        sums = pa.array([[Decimal(int(s)) for s in sums[c]] for c in used], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), sums], ["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(partial, "cluster long, n long, sums array<decimal(38,0)>")
    by_cluster = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    moved = list(centroids)
    for row in by_cluster.collect():  # k rows at most
        moved[row.cluster] = tuple(int(row[f"s{i}"]) // row.n for i in range(width))
    return moved


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, seed: str = "2", key: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """((key, cluster, distance) of every usable vector as a stored table, and the final centroids).

    Usable are vectors with exactly ``width`` components, none null or not finite; component x counts as the whole
    number floor(256 x). Centroids 0, 1, ... start as the ``k`` vectors with the smallest sha256 of "seed:key", in that
    order; rows of one key by their components, rows with a null key last. With fewer vectors there are as many
    centroids. In each round every vector goes to the nearest centroid by squared Euclidean distance, the smaller number
    if equally near, and each centroid that has vectors moves to the floor of their mean. Then all are assigned once
    more. All is computed in whole numbers of the size that is needed; a sum of one component beyond 38 digits raises,
    and a distance that no long holds is null. Repeated rows count each. An empty table gives an empty table.

    A round reads the table once and shuffles k rows of sums a task; what the driver holds and sends is k centroids.
    """
    kept = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v"), width))
    centroids = initial_centroids(kept, k, width, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                own, far = bisectors.nearest(whole(part.column(1), width))
                far = pa.array([d if d <= _LONG else None for d in far], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.astype(np.int32)), far], ["key", "cluster", "distance"])

    assigned = kept.mapInArrow(assign, f"key {kept.schema['key'].dataType.simpleString()}, cluster int, distance long")
    return written_table(assigned.withColumnRenamed("key", key), "assigned"), centroids


def centroid_digest(centroid: tuple[int, ...]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: list[tuple[int, ...]]) -> DataFrame:
    """Adds cluster_inertia, inertia (null where no long holds them) and centroid_sha256 to the stored assignment."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = assigned.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), exact).alias("s")).collect()  # k rows
    fits = lambda x: x if x is not None and x <= _LONG else None
    by_cluster = {row.cluster: None if row.s is None else int(row.s) for row in sums}
    total = None if None in by_cluster.values() else sum(by_cluster.values())
    facts = [(c, fits(s), fits(total), centroid_digest(centroids[c])) for c, s in by_cluster.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(facts, schema)), "cluster")  # k rows at most
