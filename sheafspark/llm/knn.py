"""Exact search for the largest inner products: a kNN join over Voronoi cells."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafspark.storage import written_table

#: Pivots of the data, and at most so many of the queries; queries of a block; data rows of a chunk.
DATA_PIVOTS = 64
MAX_GROUPS = 4096
BLOCK_QUERIES = 1_000
CHUNK_ROWS = 4_000


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component x as a double; null if the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def whole(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        # larger ones are whole already, and floor gives a long
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.when(finite, F.transform(vector, whole))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of all points to all pivots."""
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _lifted(points: np.ndarray, radius2: float) -> np.ndarray:
    """Data with one more component, so that all have the same length: the nearest is then the largest inner product."""
    return np.hstack([points, np.sqrt(np.maximum(radius2 - (points**2).sum(1), 0))[:, None]])


def _scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole components: floating point where it is exact, whole numbers of any size elsewhere."""
    most = (np.abs(queries).max(initial=0) * np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return queries @ data.T
    exact = [[sum(int(a) * int(b) for a, b in zip(q, s, strict=True)) for s in data] for q in queries]
    return np.array(exact, object).reshape(len(queries), len(data))


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without rows of the id ``own``."""
    places = np.flatnonzero(ids != own)
    if len(places) > k:
        some = scores[places]
        floor = sorted(some, reverse=True)[k - 1] if some.dtype == object else np.partition(some, len(some) - k)[len(some) - k]
        places = places[some >= floor]
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def knn_join(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", repeated: bool = False
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest inner product for each query row.

    Components count as floor(256 x). Queries are rows of ``vectors`` for which ``is_query`` holds; candidates are all
    rows with another key. Ties go to the smaller key. Rows with a null key, a null vector or components that are null
    or not finite take no part. A row repeated with the same key and vector counts once; with ``repeated`` each of them
    counts, as a candidate and as a query with its own answer. Shorter vectors are filled up with zeros. With fewer
    candidates all are returned; an empty table or no query gives an empty table. A score that no long holds raises.

    Data goes to the cell of its nearest pivot, queries to groups around pivots of their own. For each group, summaries
    of the cells (least and largest distance to the pivot, the smallest few distances) bound the distance of the k-th
    neighbour, and only data that can be that near is replicated to the group. Groups are solved in blocks of queries
    against chunks of data; the best of each chunk meet by query.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), whole_components(F.col(f"`{vector}`")).alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.groupBy("id", "v").agg(F.count("*").alias("m"), F.count_if("q").alias("asks"))
    # k of equal candidates are enough; the numbers of rows stay as they are written
    times = [F.least("m", F.lit(k)).alias("m"), "asks"] if repeated else [F.lit(1).alias("m"), F.least("asks", F.lit(1)).alias("asks")]
    rows = written_table(rows.select("id", "v", *times, F.monotonically_increasing_id().alias("no")), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("asks") > 0).alias("queries"),
        F.max(F.size("v")).alias("width"),
        F.max(norm).alias("radius2"),
    ).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not facts.queries:
        return rows.sparkSession.createDataFrame([], result)
    same_key = rows.groupBy("id").count().agg(F.max("count").alias("m")).first().m
    width, radius2, wanted = max(1, facts.width), facts.radius2, k + same_key

    def pivots(of: DataFrame, n: int) -> np.ndarray:
        taken = of.orderBy(F.xxhash64("id"), "id", "v").limit(n).collect()
        return np.array([list(r.v) + [0.0] * (width - len(r.v)) for r in taken])

    data_pivots = _lifted(pivots(rows, DATA_PIVOTS), radius2)
    groups = min(MAX_GROUPS, -(-facts.queries // BLOCK_QUERIES))
    group_pivots = np.hstack([pivots(rows.where("asks > 0"), groups), np.zeros((min(groups, facts.queries), 1))])

    def assign(batches: Iterator[pa.RecordBatch], points=data_pivots, lift=True) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(1), width)
                own = _lifted(own, radius2) if lift else np.hstack([own, np.zeros((len(own), 1))])
                far = _distances(own, points)
                cell = far.argmin(1)
                near = pa.array(far[np.arange(len(own)), cell])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), near], [*batch.schema.names, "cell", "far"])

    def assign_queries(batches):
        return assign(batches, group_pivots, False)

    data = rows.select("id", "v", F.col("m").cast("int"))
    data = data.mapInArrow(assign, "id long, v array<double>, m int, cell long, far double")
    data = written_table(data, "data-cells")
    queries = rows.where("asks > 0").select("id", "v", "no", "asks")
    queries = queries.mapInArrow(assign_queries, "id long, v array<double>, no long, asks long, cell long, far double")
    queries = written_table(queries, "query-groups")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, near = np.empty(0, np.int64), np.empty(0)
        for batch in batches:  # the smallest few of each cell among the rows of a task
            cells, near = np.append(cells, batch.column(0).to_numpy()), np.append(near, batch.column(1).to_numpy())
            order = np.lexsort((near, cells))
            cells, near = cells[order], near[order]
            place = np.arange(len(cells)) - np.searchsorted(cells, cells)
            cells, near = cells[place < wanted], near[place < wanted]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(near)], ["cell", "far"])

    few = data.select("cell", "far").mapInArrow(least, "cell long, far double")
    # a few distances of each pivot, whatever the number of tasks
    smallest = few.repartition("cell").mapInArrow(least, "cell long, far double").toPandas()
    radius = queries.groupBy("cell").agg(F.max("far").alias("u")).toPandas()
    u = np.zeros(len(group_pivots))
    u[radius["cell"].to_numpy()] = radius["u"].to_numpy()
    between = _distances(group_pivots, data_pivots)
    ceiling = between[:, smallest["cell"].to_numpy()] + smallest["far"].to_numpy()[None, :]
    reach = np.sort(ceiling, axis=1)[:, : wanted][:, -1] + u if ceiling.shape[1] >= wanted else np.full(len(u), np.inf)
    # rounding must not lose a neighbour at the bound itself
    slack = 1e-6 * (1 + radius2**0.5)
    low, high = between - (u + reach)[:, None] - slack, between + (u + reach)[:, None] + slack

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = batch.column("cell").to_numpy(), batch.column("far").to_numpy()
            for group in range(len(low)):
                needed = np.flatnonzero((far >= low[group, cell]) & (far <= high[group, cell]))
                if len(needed):
                    part = batch.take(pa.array(needed))
                    columns = [*part.columns[:3], pa.array(np.full(len(needed), group))]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "v", "m", "cell"])

    chunks = -(-facts.n // CHUNK_ROWS)
    sizes = queries.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    blocks = F.broadcast(sizes)  # at most MAX_GROUPS rows
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).alias("block")
    near = data.mapInArrow(replicate, "id long, v array<double>, m int, cell long").join(blocks, "cell")
    near = near.select("id", "v", "m", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), chunk)
    # the keys of both sides have the same type: an int and a long of the same value go to different partitions
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")).alias("chunk")
    asking = queries.join(blocks, "cell").select("id", "v", "no", "asks", "cell", block, every_chunk)

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            asked, own = (_matrix(t.column("v").combine_chunks(), width) for t in (left, right))
            ids = right.column("id").to_numpy()
            scores = _scores(asked, own)
            times = right.column("m").to_numpy()
            for n, (query, no, asks) in enumerate(zip(*(left.column(c).to_pylist() for c in ("id", "no", "asks")), strict=True)):
                best = _best(scores[n], ids, query, k)
                best = np.repeat(best, times[best])[:k]
                out += [(query, no, asks, int(ids[p]), int(scores[n, p])) for p in best]
        columns = list(zip(*out, strict=True)) or [()] * 5
        names = ("query_id", "no", "asks", "vec_id", "score")
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns, strict=True)})

    keys = ("cell", "block", "chunk")
    best = asking.groupBy(*keys).cogroup(near.groupBy(*keys))
    best = best.applyInArrow(solve, "query_id long, no long, asks long, vec_id long, score long")
    order = Window.partitionBy("query_id", "no").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    answers = F.explode(F.sequence(F.lit(1), "asks"))  # equal queries have equal answers
    return best.select("query_id", "rank", "vec_id", "score", answers).drop("col")
