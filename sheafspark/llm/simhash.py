"""Near-duplicates by SimHash: fingerprints that differ in few bits meet in variants half way between them."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import byte_column, each
from sheafspark.llm.components import connected_components
from sheafspark.llm.row_places import placed
from sheafspark.storage import written_table

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Distinct fingerprints of one variant that a task compares with each other; larger groups go another exact way.
COMPARED = 1024
_SHINGLES = 1 << 15


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed number.

    A-Z are lower-cased; words are runs of anything but ASCII white space; shingles of ``words`` words count as often
    as they occur. A shorter text is one shingle; without words the fingerprint is zero. A bit is 1 if it is 1 in more
    than half the shingle hashes (XXH64).
    """
    split = text.lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.append(0, ends[:-1] + 1)
    count = max(1, len(split) - words + 1)
    spans = zip(starts[:count].tolist(), ends[min(words, len(split)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, _SHINGLES):
        bits = np.unpackbits(hashes[at : at + _SHINGLES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << k for k in np.flatnonzero(2 * ones > count).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: Column) -> Column:
    """SimHash of each whole text as a long; null counts as empty."""

    @F.arrow_udf("long")
    def prints(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in each(columns):
            yield pa.array([simhash(t.as_buffer().to_pybytes()) for t in byte_column(column)], pa.int64())

    return prints(text)


def _block_masks() -> list[int]:
    """Bits of the three pairs of three blocks.

    If two fingerprints differ in at most 4 bits, they differ in at most 2 within one of the pairs.
    """
    blocks = [range(0, 22), range(22, 43), range(43, 64)]
    return [sum(1 << b for k, block in enumerate(blocks) if k != left for b in block) for left in range(3)]


def _flipped(base: Column, flips: list[int]) -> Column:
    """The number with each of the given sets of bits turned over."""
    return F.transform(F.array(*map(F.lit, flips)), lambda bits: base.bitwiseXOR(bits))


def variants(prints: DataFrame) -> DataFrame:
    """(pair, variant, fp): all variants within one bit on each pair of blocks, half of the 2 bits left there."""
    rows = []
    for pair, mask in enumerate(_block_masks()):
        flips = [0] + [1 << b for b in range(64) if mask >> b & 1]
        signed = [x - (1 << 64) if x >> 63 else x for x in [mask, *flips]]
        base = F.col("fp").bitwiseAND(F.lit(signed[0]))
        rows.append(prints.select(F.lit(pair).cast("byte").alias("pair"), F.explode(_flipped(base, signed[1:])).alias("variant"), "fp"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def ball(prints: DataFrame) -> DataFrame:
    """(variant, fp): all variants within two bits of all 64. Fingerprints of one variant differ in at most 4 bits."""
    single = [1 << b for b in range(64)]
    flips = [0, *single, *(a | b for i, a in enumerate(single) for b in single[:i])]
    signed = [x - (1 << 64) if x >> 63 else x for x in flips]
    return prints.select(F.explode(_flipped(F.col("fp"), signed)).alias("variant"), "fp")


def _differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of bits in which fingerprints differ; of signed numbers numpy counts the bits of the absolute value."""
    return np.bitwise_count((left ^ right).astype(np.int64).view(np.uint64))


def _links_of(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links that connect what is connected within one group of distinct fingerprints: a forest of them."""
    root = np.arange(len(group))
    left, right = [], []
    for i in range(1, len(group)):
        near = np.flatnonzero(_differing(group[:i], group[i]) <= RADIUS)
        joined = np.unique(root[near])
        for r in joined:
            left.append(group[near[np.flatnonzero(root[near] == r)[0]]])
            right.append(group[i])
            root[: i + 1][root[: i + 1] == r] = i
        root[i] = i
    return np.array(left, np.int64), np.array(right, np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) among sorted rows (pair, variant, fp); a row with b null is a member of a large group."""

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    open_key, members, large = None, [], False

    def close():
        if large:
            return [(m, np.full(len(m), -1), True) for m in members]
        group = np.unique(np.concatenate(members))
        return [(*_links_of(group), False)] if len(group) > 1 else []

    def emitted(results):
        for a, b, is_large in results:
            if len(a):
                yield out(a, [None] * len(a) if is_large else b)

    for batch in each(batches):
        pair, variant, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        if not len(fp):
            continue
        # two members inside the batch, the most common meeting, are compared all at once
        cut = np.flatnonzero((pair[1:] != pair[:-1]) | (variant[1:] != variant[:-1])) + 1
        bounds = [0, *cut.tolist(), len(fp)]
        sizes = np.diff(bounds)
        last = len(sizes) - 1
        twos = np.array(bounds)[np.flatnonzero(sizes[1:last] == 2) + 1]
        near = twos[(_differing(fp[twos], fp[twos + 1]) <= RADIUS) & (fp[twos] != fp[twos + 1])] if len(twos) else twos
        if len(near):
            both = np.unique(np.stack([fp[near], fp[near + 1]]), axis=1)
            yield out(both[0], both[1])
        for k in [0, *(np.flatnonzero(sizes[1:last] > 2) + 1).tolist(), *([last] if last else [])]:
            start, stop = bounds[k], bounds[k + 1]
            key = (pair[start], variant[start])
            if key != open_key:
                if members:
                    yield from emitted(close())
                open_key, members, large = key, [], False
            members.append(fp[start:stop])
            if sum(map(len, members)) > COMPARED:  # fingerprints are distinct in a group
                large = True
                yield from emitted(close())
                members = []
    if members:
        yield from emitted(close())


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp), enough to connect all that differ in at most ``RADIUS`` bits.

    Fingerprints meet in variants; those of one variant are compared, and the verified links that connect them stay.
    Members of a group with more than ``COMPARED`` fingerprints emit their whole ball of radius 2 instead, where every
    meeting is a link by itself, and only a star of links leaves a variant.
    """
    met = variants(prints).repartition("pair", "variant").sortWithinPartitions("pair", "variant", "fp")
    found = written_table(met.mapInArrow(_links, "a long, b long"), "simhash-meetings")
    crowded = written_table(found.where("b is null").select(F.col("a").alias("fp")).distinct(), "simhash-crowded")
    links = found.where("b is not null")
    if crowded.isEmpty():
        return links.distinct()
    around = ball(crowded)
    centre = around.groupBy("variant").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).where("a < last")
    star = around.join(centre.drop("last"), "variant").where("fp > a").select("a", F.col("fp").alias("b"))
    # a fingerprint of a small group only can still be near one of a large group: both are then in that large group
    return links.unionByName(star).distinct()


def _components(prints: DataFrame) -> DataFrame:
    """(fp, least, root) for a stored table (key, fp, ...): each fingerprint with its least order and its component."""
    distinct = written_table(prints.groupBy("fp").agg(F.min("order").alias("least")), "distinct-fingerprints")
    components = connected_components(near_links(distinct.select("fp")))
    return distinct.join(components, distinct.fp == components.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row of ``docs``: key, ``fp`` (long), ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are linked if their fingerprints differ in at most 4 bits; ``component_id`` is the smallest key that links
    reach, the row's own included; null keys are never the smallest. Null and empty texts have fingerprint zero and are
    linked like others. Repeated rows share a component. An empty table gives an empty table.
    """
    prints = docs.select(F.col(f"`{key}`").alias("order"), fingerprint(F.col(f"`{text}`")).alias("fp"))
    prints = written_table(prints, "fingerprints")
    found = _components(prints)
    roots = found.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = written_table(found.join(roots, "root").select("fp", "component_id"), "fingerprint-components")
    return prints.join(by_print, "fp").select(
        F.col("order").alias(key), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def simhash_survivors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, a stored table, without those linked to a row with a smaller key; see :func:`simhash_groups`.

    Of rows with the smallest key one stays, a null key being the largest. All columns are kept as they are.
    """
    docs, place = placed(docs)  # tells rows with the same key apart
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), place.alias("n"), F.col(f"`{text}`").alias("text"))
    order = F.struct(F.col(f"row.`{key}`").isNull().alias("without"), F.col(f"row.`{key}`").alias("key"), "n")
    prints = written_table(rows.select(order.alias("order"), fingerprint(F.col("text")).alias("fp")), "fingerprints")
    found = _components(prints)
    kept = found.groupBy("root").agg(F.min("least").alias("least")).select("least.n")
    kept = written_table(kept, "kept-rows")
    # whole rows move in the same way at every size
    return rows.select("row", "n").join(kept.hint("merge"), "n", "left_semi").select("row.*")


def whole_ball_rows(radius: int = RADIUS) -> int:
    """Rows a fingerprint would emit with the ball on all 64 bits only."""
    return sum(math.comb(64, k) for k in range(radius // 2 + 1))
