"""Quality scores by co-training: a classifier of the content and one of the layout teach each other."""

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import byte_column, each, row_slices
from sheafspark.llm.toxicity import Ftrl, held_out, labelled_sample, sigmoid
from sheafspark.llm.word_features import Hasher, shape_tokens
from sheafspark.storage import written_table

#: About so many labelled rows of each class take part in the learning.
ROWS_PER_CLASS = 5_000
#: Of the rows that a view labels in a round, a learner fits about so many of each class, spread over all of them by a hash.
PSEUDO_ROWS = 1_000
ROUNDS = 4
EPOCHS = 6
#: Pseudo-labels have at least this confidence; of each class, a round takes this part of the unlabelled rows at most.
CONFIDENCE = 0.95
TAKEN = 0.1
BUCKETS = 1 << 16
#: Longer words are read in overlapping windows of so many characters.
WINDOW = 64
THRESHOLD = 0.5
#: The most frequent languages and sources have a slot each; all others share one.
LANGS, SOURCES = 64, 256
#: Steps of confidence, as a logit, in which rows are counted.
BINS = 20


class ContentView:
    """What stands in a text: hashed kinds of words, pairs of them, and how often a word follows itself."""

    def __init__(self):
        self.hasher = Hasher(shape_tokens, BUCKETS - 4, WINDOW)

    def features(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Features of all texts in one array, and their number by text."""
        values, sizes = [np.empty(0, np.int64)], []
        for start, stop in row_slices(column):
            texts = column.slice(start, stop - start).to_pylist()
            at, found = self.hasher.pairs(texts)
            repeats = []
            for text in texts:
                words = text.split()
                share = sum(map(eq, words, words[1:])) / max(1, len(words))
                repeats.append(BUCKETS - 4 + (share > 0.05) + (share > 0.2) + (share > 0.5))
            count = np.bincount(at, minlength=len(texts))
            values.append(np.insert(found, np.cumsum(count), repeats))
            sizes.append(count + 1)
        return np.concatenate(values), np.concatenate([np.empty(0, np.int64), *sizes])


def layout(text: bytes) -> list[float]:
    """Size and shape of a page."""
    data = np.frombuffer(text, np.uint8)
    n = max(1, len(data))
    lines = text.split(b"\n")
    words = text.split()
    upper = ((data >= 65) & (data <= 90)).sum() / n
    digits = ((data >= 48) & (data <= 57)).sum() / n
    marks = np.isin(data, np.frombuffer(b"%$#&*|!", np.uint8)).sum() / n
    ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / len(lines)
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        np.log1p(len(words) / len(lines)),
        len(data) / max(1, len(words)) / 10,
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / len(lines),
        min(1.0, 10 * upper),
        min(1.0, 10 * digits),
        min(1.0, 10 * marks),
        ends,
    ]


NUMBERS = 11


class Model:
    """Weights of both views and the calibration of each; slot 0 of languages and sources is null and has no weight."""

    def __init__(self):
        self.content, self.content_bias = np.zeros(BUCKETS), np.zeros(1)
        self.mean, self.scale, self.layout = np.zeros(NUMBERS), np.ones(NUMBERS), np.zeros(NUMBERS + 1)
        self.langs, self.sources = np.zeros(LANGS + 2), np.zeros(SOURCES + 2)
        self.calibration = np.array([1.0, 0.0, 1.0, 0.0])

    def logits(self, flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, lang: np.ndarray, source: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        content = np.bincount(owner, weights=self.content[flat], minlength=len(sizes)) + self.content_bias
        shape = (numbers - self.mean) / self.scale @ self.layout[:-1] + self.layout[-1]
        return np.stack([content, shape + self.langs[lang] + self.sources[source]])

    def score(self, logits: np.ndarray) -> np.ndarray:
        """Both views after calibration, with the same weight."""
        calibration = self.calibration.reshape(2, 2)
        return sigmoid((calibration[:, :1] * np.clip(logits, -12, 12) + calibration[:, 1:]).mean(0))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 25) -> np.ndarray:
    """Weights and bias by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + l2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + l2 * w)
    return w


def _inputs(flat: pa.Array, numbers: pa.Array, lang: pa.Array, source: pa.Array) -> tuple:
    """Columns of the views as arguments of :meth:`Model.logits`."""
    shapes = numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, NUMBERS)
    return flat.flatten().to_numpy(zero_copy_only=False), np.diff(flat.offsets.to_numpy()), shapes, lang.to_numpy(), source.to_numpy()


def fit(inputs: tuple, labels: np.ndarray, ids: np.ndarray, taught: np.ndarray, model: Model, turn: int) -> None:
    """Learns both views from rows with labels; ``taught`` is the view that a pseudo-label is for, -1 for a given label.

    Later labels of a row replace earlier ones. Every fourth given label only calibrates.
    """
    flat, sizes, numbers, lang, source = inputs
    given = np.flatnonzero(taught < 0)
    if len(np.unique(labels[given])) < 2:
        only = labels[given].mean() if len(given) else 0.5
        model.content_bias[:] = model.layout[-1] = float(np.clip(8 * (only - 0.5), -4, 4))
        return
    rows = np.split(flat, np.cumsum(sizes)[:-1])
    apart = given[3::4] if len(given) >= 40 else given
    own = np.setdiff1d(given, apart) if len(given) >= 40 else given
    known = []
    for view in (0, 1):
        pseudo = np.flatnonzero(taught == view)
        last = {int(ids[r]): r for r in pseudo}
        known.append(np.concatenate([own, np.array(sorted(last.values()), int)]))
    learner = Ftrl(BUCKETS, l1=2.0)
    for epoch in range(EPOCHS):
        for r in np.random.default_rng(100 * turn + epoch).permutation(known[0]):
            learner.learn(rows[r], labels[r])
    model.content, model.content_bias = learner.weights(slice(None)), np.array([learner.bias()])
    r = known[1]
    n_lang, n_source = int(lang.max()), int(source.max())
    one = [np.eye(n + 1)[slot[r]][:, 1:] for n, slot in ((n_lang, lang), (n_source, source))]
    w = _logistic(np.hstack([(numbers[r] - model.mean) / model.scale, *one]), labels[r].astype(float), 1.0)
    model.layout = np.append(w[:NUMBERS], w[-1])
    model.langs[1 : n_lang + 1] = w[NUMBERS : NUMBERS + n_lang]
    model.sources[1 : n_source + 1] = w[NUMBERS + n_lang : -1]
    logits = model.logits(*inputs)
    for view in (0, 1):
        fitted = _logistic(np.clip(logits[view][apart], -12, 12)[:, None], labels[apart].astype(float), 0.5)
        model.calibration[2 * view : 2 * view + 2] = fitted if fitted[0] > 0 else (1.0, 0.0)


VIEWS = ["flat", "numbers", "lang", "source"]


def _slot(value: Column, docs: DataFrame, most: int) -> Column:
    """0 for null, 1 for rare values, and a number of its own for each of the ``most`` frequent ones."""
    text = value.cast("string")
    count = docs.groupBy(text.alias("v")).count().where("v IS NOT NULL")
    frequent = [r.v for r in count.orderBy(F.desc("count"), "v").limit(most).collect()]
    place = F.array_position(F.array(*map(F.lit, frequent)), text) if frequent else F.lit(0)
    return F.when(value.isNull(), 0).otherwise(place + 1).cast("int")


def views_of(docs: DataFrame, key: str, text: str, lang: str, source: str, carried: list[str]) -> DataFrame:
    """A stored table with one row for each of ``docs``: the columns it carries as ``row``, its key and both views."""

    @F.arrow_udf("struct<flat: array<int>, numbers: array<double>>")
    def read(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        content = ContentView()
        for texts in each(columns):
            texts = byte_column(texts)
            flat, sizes = content.features(texts)
            ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            shapes = np.array([layout(t.as_buffer().to_pybytes()) for t in texts], float)
            around = pa.array((np.arange(len(texts) + 1) * NUMBERS).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32))), pa.ListArray.from_arrays(around, pa.array(shapes.ravel()))]
            yield pa.StructArray.from_arrays(lists, ["flat", "numbers"])

    page = F.col(f"`{source}`") if source in docs.columns else F.lit(None).cast("string")
    read_rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.col(f"`{key}`").alias("key"),
        _slot(F.col(f"`{lang}`"), docs, LANGS).alias("lang"),
        _slot(page, docs, SOURCES).alias("source"),
        read(F.col(f"`{text}`")).alias("view"),
    )
    return written_table(read_rows.select("row", "key", "view.flat", "view.numbers", "lang", "source"), "views")


def pseudo_labels(pool: DataFrame, rows: int, model: Model, turn: int) -> DataFrame:
    """Rows of the whole ``pool`` of which one view is sure, labelled for the other view; a stored table.

    All rows are scored. Of each class, those above the confidence that TAKEN of the pool reach are labelled; the learner
    gets about PSEUDO_ROWS of them, chosen by a hash that changes with the round.
    """
    shared = pool.sparkSession.sparkContext.broadcast(vars(model))
    least = float(np.log(CONFIDENCE / (1 - CONFIDENCE)))

    def judged(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        model = Model()
        vars(model).update(shared.value)
        for view, logit in enumerate(model.logits(*_inputs(*(batch.column(k) for k in range(4))))):
            size = np.minimum(np.abs(logit), 35.0)
            yield 1 - view, size >= least, (logit > 0).astype(np.int32), (size * BINS).astype(np.int32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for view, sure, label, step in judged(batch):
                found, n = np.unique(np.stack([label[sure], step[sure]]), axis=1, return_counts=True)
                columns = [np.full(len(n), view, np.int32), *found.astype(np.int32), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["taught", "label", "step", "n"])

    counted = pool.select(*VIEWS).mapInArrow(count, "taught int, label int, step int, n long")
    steps: dict = {}
    for r in counted.groupBy("taught", "label", "step").agg(F.sum("n").alias("n")).collect():
        steps.setdefault((r.taught, r.label), {})[r.step] = r.n
    shares = np.zeros((2, 2, 35 * BINS + 1))
    for (view, label), sizes in steps.items():
        room = min(TAKEN * rows, sum(sizes.values()))
        part = min(1.0, PSEUDO_ROWS / max(1.0, room))
        for step in sorted(sizes, reverse=True):
            shares[view, label, step] = part * min(1.0, room / sizes[step])
            room -= min(room, sizes[step])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for view, sure, label, step in judged(batch):
                at = np.flatnonzero(sure & (batch.column(5 + view).to_numpy() < shares[view, label, step]))
                found = [batch.column(k).take(pa.array(at)) for k in range(5)]
                ends = [pa.array(np.full(len(at), view, np.int32)), pa.array(label[at])]
                yield pa.RecordBatch.from_arrays([*found, *ends], [*names, "taught", "label"])

    names = [*VIEWS, "id"]
    place = [F.pmod(F.xxhash64("id", F.lit(2 * turn + v)), F.lit(1 << 20)) / (1 << 20) for v in (0, 1)]
    kinds = "flat array<int>, numbers array<double>, lang int, source int, id long, taught int, label int"
    chosen = pool.select(*names, place[0].alias("p0"), place[1].alias("p1")).mapInArrow(choose, kinds)
    return written_table(chosen.withColumn("turn", F.lit(turn)), "pseudo-labels")


def train(viewed: DataFrame, labels: DataFrame, key: str) -> Model:
    """Learns from a bounded sample of labelled rows and, over rounds, from what the views say about all unlabelled ones."""
    row_id = F.xxhash64("key", "flat", "numbers", "lang", "source").alias("id")
    labels = labels.withColumnRenamed(key, "key")
    packed = viewed.select("key", F.struct(*VIEWS, row_id).alias("view"))
    given = labelled_sample(packed, labels, "key", "view", "quality", ROWS_PER_CLASS)
    given = given.select(*[F.col("text")[c].alias(c) for c in [*VIEWS, "id"]], F.lit(-1).alias("taught"), "label", F.lit(-1).alias("turn"))
    given = written_table(given, "given-labels")
    free = viewed.where(F.col("key").isNotNull() & ~held_out(F.col("key")))
    model = Model()
    shape = [f(F.col("numbers")[k]) for f in (F.avg, F.stddev_pop) for k in range(NUMBERS)]
    shape = list(free.select(*shape).first())
    if shape[0] is not None:
        # sums differ in their last digits with the order of rows
        model.mean, model.scale = np.round(shape[:NUMBERS], 6), np.round(shape[NUMBERS:], 6) + 1e-6
    pool = free.join(labels.where("quality IS NOT NULL").select("key"), "key", "left_anti")
    pool = written_table(pool.select(*VIEWS, row_id), "unlabelled")
    rows = pool.count() if given.select("label").distinct().count() == 2 else 0
    taught = given
    for turn in range(ROUNDS + 1):
        model = _fitted(taught, model, turn)
        if turn == ROUNDS or not rows:
            return model
        taught = taught.unionByName(pseudo_labels(pool, rows, model, turn))


def _fitted(taught: DataFrame, model: Model, turn: int) -> Model:
    """The model after learning in one task, whose input is bounded."""
    shape = (model.mean, model.scale)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        model = Model()
        model.mean, model.scale = shape
        if parts:
            inputs = [_inputs(*(b.column(k) for k in range(4))) for b in parts]
            ids, views, labels = (np.concatenate([b.column(k).to_numpy() for b in parts]) for k in (4, 5, 6))
            fit(tuple(np.concatenate(x) for x in zip(*inputs, strict=True)), labels, ids, views, model, turn)
        values = pa.array([np.asarray(v, float) for v in vars(model).values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(vars(model))), values], ["name", "value"])

    # the order of steps is one that reruns repeat
    ordered = taught.repartition(1).sortWithinPartitions("turn", "taught", "id", "label")
    ordered = ordered.select(*VIEWS, "id", "taught", "label")
    learned = Model()
    learned.mean, learned.scale = shape
    for r in ordered.mapInArrow(learn, "name string, value array<double>").collect():
        setattr(learned, r["name"], np.array(r.value))
    return learned


def score(viewed: DataFrame, model: Model) -> Column:
    """The probability of good quality of each whole text."""
    # plain values: executors need no installed copy of the class
    shared = viewed.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def scores(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        model = Model()
        vars(model).update(shared.value)
        for views in each(columns):
            yield pa.array(model.score(model.logits(*_inputs(*views))))

    return scores(*VIEWS)


def quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", with_text: bool = True
) -> DataFrame:
    """Adds held_out, score (0 to 1), predicted (1: good) and kept to every row.

    Labels (key, quality) teach only, and only rows outside the held-out part. Two classifiers, of the content and of
    the layout, language and source, label unlabelled rows for each other over rounds; in each round all of them are
    scored. The calibrated views are combined. Null and empty texts and null languages and sources are rows like others,
    and so is a table without sources. Without labels of both classes every row has the same score. Repeated rows are
    scored each; an empty table gives an empty table. Columns of the four names are replaced. What both views see is
    stored once with the other columns, without the text if it is not wanted.
    """
    columns = [c for c in docs.columns if c not in ("held_out", "score", "predicted", "kept") and (with_text or c != text)]
    viewed = views_of(docs, key, text, lang, source, columns)
    model = train(viewed, labels, key)
    scored = viewed.select("row", held_out(F.col("key")).alias("held_out"), score(viewed, model).alias("score"))
    good = F.col("score") >= THRESHOLD
    return scored.select(
        *[F.col("row")[c].alias(c) for c in columns], "held_out", "score", good.cast("int").alias("predicted"), good.alias("kept")
    )
