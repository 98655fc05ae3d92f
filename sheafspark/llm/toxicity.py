"""Toxicity scores: logistic regression over hashed features, learned by FTRL-proximal."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import byte_column, each, give_back, row_slices
from sheafspark.llm.word_features import BUCKETS, Hasher, word_tokens
from sheafspark.storage import written_table

#: About so many labelled rows of each class are learned from; a larger class is thinned by a hash of the key.
ROWS_PER_CLASS = 8_000
EPOCHS = 10
#: Features of fewer rows of the sample are not learned.
LEAST_ROWS = 3
#: Scores from here on are predicted as 1.
THRESHOLD = 0.7


class Ftrl:
    """FTRL-proximal with a learning rate for each coordinate; L1 keeps coordinates at zero that little speaks for."""

    def __init__(self, buckets: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(buckets), np.zeros(buckets)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -pull / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n**0.5) / self.alpha)

    def learn(self, at: np.ndarray, label: float) -> None:
        """One step on a row with distinct features ``at``, all of value 1."""
        w, bias = self.weights(at), self.bias()
        gradient = sigmoid(w.sum() + bias) - label
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown
        grown = self.bias_n + gradient * gradient
        self.bias_z += gradient - (grown**0.5 - self.bias_n**0.5) / self.alpha * bias
        self.bias_n = grown


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def held_out(key: Column) -> Column:
    """Rows kept from all learning: crc32 of the key as text leaves 1 when divided by 3; not so for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int) -> DataFrame:
    """(key, text, label, share): labelled rows outside the held-out part, about ``per_class`` of each class.

    Several labels of a key are averaged, half and more being 1; null labels and keys are left out. ``share`` is the
    part of its class that was taken.
    """
    one = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label"))
        .where(F.col("label").isNotNull() & F.col("key").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    size = {r.label: r["count"] for r in one.groupBy("label").count().collect()}
    shares = {k: min(1.0, per_class / n) for k, n in size.items()}
    share = F.when(F.col("label") == 1, shares.get(1, 1.0)).otherwise(shares.get(0, 1.0))
    place = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 20)) / (1 << 20)
    taken = written_table(one.select("key", "label", share.alias("share")).where(place < F.col("share")), "labelled")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    # two classes of about per_class rows
    return rows.join(F.broadcast(taken), "key")


def text_features(text: Column, tokens=word_tokens) -> Column:
    """The distinct features of each whole text, sorted."""

    @F.arrow_udf("array<int>")
    def features(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher(tokens)
        for column in each(columns):
            column = byte_column(column)
            values, sizes = [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
            for start, stop in row_slices(column):
                at, found = hasher.pairs(column.slice(start, stop - start).to_pylist())
                values.append(found)
                sizes.append(np.bincount(at, minlength=stop - start))
            offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).astype(np.int32)))

    return features(text)


class SparseModel:
    """Non-zero weights and the bias; small enough to broadcast, at most one weight a bucket."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float):
        self.at, self.weights, self.bias = at, weights.astype(np.float32), bias

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.at] = self.weights
        return out


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> SparseModel:
    """Learns from a bounded sample of labelled rows; see :func:`labelled_sample`. Without both classes nothing is learned."""
    sample = labelled_sample(docs, labels, key, text, label, ROWS_PER_CLASS)
    rows = sample.select("key", "label", "share", text_features(F.col("text")).alias("features"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, targets, weight = [], [], {0: 0.0, 1: 0.0}
        rows_with = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            column = batch.column(3)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            parts.append((flat, column.offsets.to_numpy() - column.offsets[0].as_py()))
            rows_with += np.bincount(flat, minlength=BUCKETS).astype(np.int32)
            targets += batch.column(1).to_pylist()
            for y, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                weight[y] += 1 / s
        kept = rows_with >= LEAST_ROWS
        features = []
        for flat, offsets in parts:  # one by one, as all of them together are large
            wanted = kept[flat]
            upto = np.append(0, np.cumsum(wanted, dtype=np.int32))[offsets]
            features += np.split(flat[wanted], upto[1:-1])
        parts.clear()
        model = Ftrl(BUCKETS)
        if weight[0] and weight[1]:
            for epoch in range(EPOCHS):
                for k in np.random.default_rng(epoch).permutation(len(targets)):
                    model.learn(features[k], targets[k])
            # the classes were thinned by different shares
            bias = model.bias() + np.log(weight[1] / weight[0] / (sum(targets) / (len(targets) - sum(targets))))
        else:
            bias = -5.0
        weights = model.weights(slice(None))
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(weights[at], bias))], ["at", "weight"])
        del features, model, weights
        give_back()

    # the sample is bounded; steps follow each other, in an order that reruns repeat
    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("key"), "key", F.size("features"))
    learned: pd.DataFrame = ordered.mapInArrow(learn, "at long, weight double").toPandas()
    if learned.empty:
        return SparseModel(np.empty(0, np.int64), np.empty(0), -5.0)
    bias = learned[learned["at"] < 0]
    learned = learned[learned["at"] >= 0]
    return SparseModel(learned["at"].to_numpy(), learned["weight"].to_numpy(), float(bias["weight"].iloc[0]))


def score(text: Column, model: SparseModel, docs: DataFrame) -> Column:
    """The probability of class 1 for each whole text; null counts as empty, and an empty text has the bias only."""
    # plain values: executors need no installed copy of the class
    shared = docs.sparkSession.sparkContext.broadcast((model.at, model.weights, model.bias))

    @F.arrow_udf("double")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = SparseModel(*shared.value)
        weights, bias = model.dense(), model.bias
        hasher, wanted = Hasher(word_tokens), weights != 0
        for column in each(columns):
            column = byte_column(column)
            total = np.full(len(column), bias)
            for start, stop in row_slices(column):
                at, found = hasher.pairs(column.slice(start, stop - start).to_pylist(), wanted)
                total[start:stop] += np.bincount(at, weights=weights[found], minlength=stop - start)
            yield pa.array(sigmoid(total))

    return scores(text)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds held_out, score (0 to 1) and predicted (1 from 0.7 on) to every row.

    Labels (key, toxic) teach only, and only rows outside the held-out part; inputs of a score are the text's words.
    Null and empty texts get the score of a text without features. Without labels of both classes every row has the
    same low score. Repeated rows are scored each; an empty table gives an empty table. Columns of the three names
    are replaced.
    """
    model = train(docs, labels, key, text)
    columns = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    scored = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        held_out(F.col(f"`{key}`")).alias("held_out"),
        score(F.col(f"`{text}`"), model, docs).alias("score"),
    )
    return scored.select(
        *[F.col("row")[c].alias(c) for c in columns], "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
