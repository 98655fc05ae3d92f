"""Conversation structure repair: faults, the cheapest edits, and the repaired messages, for conversations of any length."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sheafspark.llm.arrow_text import each
from sheafspark.llm.audit_paths import STATES, Chain, Paths, Replay, cheapest, row_kind
from sheafspark.storage import written_table

#: A conversation within these bounds is repaired where its rows lie; a longer one in segments of so many rows.
LOCAL_ROWS, LOCAL_BYTES = 4_096, 16 << 20
SEGMENT_ROWS = 8_192
#: Rows of an Arrow batch that a task puts out.
_OUT_ROWS = 2_000
_WHITE = " \t\n\x0b\x0c\r"
#: Kinds of records that lie side by side in the stored table of the first pass.
_DONE, _MESSAGE, _OPEN = 0, 1, 2

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {"su", "ua", "au"}


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, live): the rows with faults put in by crc32(conv:turn) % 20, nulls counting as one space.

    0 drops the row, which stays as one that is not ``live``, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it,
    4 makes its role user.
    """
    conv, turn = F.col(f"`{conv}`"), F.col(f"`{turn}`")
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)])
    fault = F.crc32(key.cast("binary")) % 20
    own = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    rows = rows.select(
        conv.alias("conv"),
        turn.alias("turn"),
        F.when(fault == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`"), F.lit(" "))).alias("role"),
        F.when(fault == 0, None).when(fault == 1, "").when(fault == 2, F.translate(own, ".!?", "")).otherwise(own).alias("text"),
        (fault != 0).alias("live"),
        F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("times"),
    )
    return rows.select("conv", "turn", "role", "text", "live", F.explode("times").alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Adds what the program needs of a text: a digest of role and text, blank, truncated."""
    end = F.rtrim("text", F.lit(_WHITE))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.select(
        *("conv", "turn", "role", "text", "live"),
        digest.alias("digest"),
        (end == "").alias("is_blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
    )


class _Out:
    """Collects records and puts them out in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.ready = schema, [], []

    def add(self, *row) -> None:
        self.rows.append(row)

    def batches(self, all_rows: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_rows or len(self.rows) >= _OUT_ROWS):
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows = []


class _Tally:
    """What a conversation's live rows, read in order, say by themselves: counts and the hash of the repaired text."""

    def __init__(self):
        self.turns = self.illegal = self.messages = 0
        self.first_turn = self.last_turn = self.initial = None
        self.sha = hashlib.sha256()

    def row(self, turn, role: str) -> None:
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in _LEGAL
        self.initial = role[:1]

    def message(self, role: str, text: str) -> int:
        self.messages += 1
        self.sha.update(f"{'' if self.messages == 1 else chr(10)}{role}:{text}".encode())
        return self.messages

    def gaps(self) -> int:
        return 0 if self.last_turn is None else int(self.last_turn - self.first_turn + 1 - self.turns)


def _faults(rows, seen: set) -> tuple[list[int], list[int]]:
    """Kinds of live rows (turn, role, text, digest, blank, truncated), and how many are blank, duplicate and truncated."""
    kinds, counts = [], [0, 0, 0]
    for _, role, _, digest, blank, cut in rows:
        again = digest in seen
        seen.add(digest)
        first = 0 if blank else 1 if again else 2 if cut else None
        if first is not None:
            counts[first] += 1
        kinds.append(row_kind(role[:1], first in (0, 1), first == 2))
    return kinds, counts


def _followed(letters: Iterator[str], replay: Replay, turn, role: str, text: str, tally: _Tally) -> Iterator[tuple]:
    """(number, letter, turn, role, text) of the messages up to a row's own; a deleted row has none."""
    for letter in letters:
        to = replay.role(letter, role)
        if letter == "I":
            yield tally.message(to, ""), letter, None, to, ""
            continue
        if to is not None:
            yield tally.message(to, text), letter, turn, to, text
        return


def _schemas(rows: DataFrame) -> tuple[str, str]:
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    record = (
        f"kind int, conv {conv}, slice long, place long, turn {turn}, role string, text string, digest binary, is_blank boolean, "
        f"is_cut boolean, live boolean, number long, edit string, {' long, '.join(COUNTS)} long, audit string, repaired_sha256 string"
    )
    return conv, record


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _nearby(record: str, messages: bool):
    """The first pass over rows that are sorted by conversation and turn, in slices that each are one task.

    Conversations that lie in a slice as a whole are repaired. The first and the last of a slice may go on in another
    one, and long ones would not fit: their rows go on as they are, with their place.
    """

    schema = _arrow(record)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        none = (None,) * (len(COUNTS) + 2)
        number, place, conv, held, size, passing = TaskContext.get().partitionId(), 0, None, [], 0, True

        def go_on():
            for at, turn, role, text, digest, blank, cut, live in held:
                out.add(_OPEN, conv, number, at, turn, role, text, digest, blank, cut, live, None, None, *none)

        def finish():
            live = [r[1:7] for r in held if r[7]]
            kinds, (blank, again, cut) = _faults(live, set())
            cost, audit = cheapest(kinds)
            tally, replay, letters = _Tally(), Replay(), iter(audit)
            for turn, role, text, *_ in live:
                tally.row(turn, role)
                for message in _followed(letters, replay, turn, role, text, tally):
                    if messages:
                        put(message)
            for message in _followed(letters, replay, None, "", "", tally):
                if messages:
                    put(message)
            facts = (tally.gaps(), blank, again, cut, tally.illegal, cost, audit, tally.sha.hexdigest())
            out.add(_DONE, conv, number, None, *(None,) * 9, *facts)

        def put(message):
            n, letter, turn, role, text = message
            out.add(_MESSAGE, conv, None, None, turn, role, text, *(None,) * 4, n, letter, *none)

        for batch in each(batches):
            for own, turn, role, text, live, digest, blank, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not place or own != conv:
                    if place and not passing:
                        finish()
                    conv, held, size, passing = own, [], 0, not place
                row = (place, turn, role, text, digest, blank, cut, live)
                held.append(row)
                place += 1
                size += len(text or "")
                if passing or len(held) > LOCAL_ROWS or size > LOCAL_BYTES:
                    passing = True
                    go_on()
                    held = []
                yield from out.batches()
        go_on()
        yield from out.batches(True)

    return near


def _segments(open_rows: DataFrame) -> DataFrame:
    """Costs, ranks and audits from every state to every state for each segment of the conversations that go on.

    A segment is what one conversation has in a range of places of a slice. The first row with a role and text is found
    by an aggregate whose partial sums meet on the map side; rows then meet it by their own place, so no key is hot.
    """
    at = ("slice", "place")
    rows = open_rows.where("live").select("conv", *at, "role", "digest", "is_blank", "is_cut")
    by_slice = rows.groupBy("conv", "digest", "slice").agg(F.min("place").alias("place"))
    first = by_slice.groupBy("conv", "digest").agg(F.min(F.struct(*at)).alias("first")).select("first.*", F.lit(True).alias("first"))
    known = rows.select("conv", *at, F.substring("role", 1, 1).alias("initial"), "is_blank", "is_cut").join(first, list(at), "left")
    part = F.floor(F.col("place") / SEGMENT_ROWS).alias("part")
    known = known.select("conv", *at, part, "initial", "is_blank", F.col("first").isNull().alias("again"), "is_cut")
    conv = open_rows.schema["conv"].dataType.simpleString()
    ddl = f"conv {conv}, slice long, place long, blank long, duplicate long, truncated long, costs array<long>, ranks array<int>, audits array<string>"

    schema = _arrow(ddl)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        key, start, paths, counts = None, None, None, None

        def close():
            held = [p.best[s] for p in paths for s in range(STATES)]
            costs = [None if h is None else h[0] for h in held]
            audits = [None if h is None else h[1].letters() for h in held]
            out.add(*start, *counts, costs, [r for p in paths for r in p.ranks()], audits)

        for batch in batches:
            for conv, slice_no, place, part, initial, blank, again, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (slice_no, part, conv):
                    if paths:
                        close()
                    key, start, counts = (slice_no, part, conv), (conv, slice_no, place), [0, 0, 0]
                    paths = [Paths(s) for s in range(STATES)]
                first = 0 if blank else 1 if again else 2 if cut else None
                if first is not None:
                    counts[first] += 1
                kind = row_kind(initial, first in (0, 1), first == 2)
                for p in paths:
                    p.row(kind)
            yield from out.batches()
        if paths:
            close()
        yield from out.batches(True)

    sorted_rows = known.repartition("slice", "part").sortWithinPartitions("slice", "part", "place")
    return written_table(sorted_rows.mapInArrow(solve, ddl), "audit-segments")


def _chosen(segments: DataFrame) -> DataFrame:
    """(slice, place, entry, exit, total) of each segment: its part of the cheapest way through the conversation.

    A task holds four bytes a segment of one conversation, and streams the rest.
    """
    ddl = "slice long, place long, entry int, exit int, last boolean, total long"

    schema = _arrow(ddl)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        conv, chain, places = None, None, []

        def close():
            total, states = chain.states()
            for n, at in enumerate(places):
                last = n == len(places) - 1
                out.add(*at, states[n], states[n + 1], last, total if last else None)

        for batch in batches:
            for own, slice_no, place, costs, ranks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chain is None or own != conv:
                    if chain is not None:
                        close()
                    conv, chain, places = own, Chain(), []
                chain.add(costs, ranks)
                places.append((slice_no, place))
            yield from out.batches()
        if chain is not None:
            close()
        yield from out.batches(True)

    narrow = segments.select("conv", "slice", "place", "costs", "ranks")
    return narrow.repartition("conv").sortWithinPartitions("conv", "slice", "place").mapInArrow(choose, ddl)


def _far(open_rows: DataFrame, record: str, messages: bool) -> DataFrame:
    """Repairs conversations that go over slices or are long, from their stored rows.

    Their audits come in segments. Their rows pass in order through one task a conversation, which holds one row at a
    time beside the audit itself: a hash over the whole repaired text has no parts that could be put together.
    """
    segments = _segments(open_rows)
    chosen = _chosen(segments)
    audit = F.element_at("audits", F.col("entry") * STATES + F.col("exit") + 1)
    heads = segments.join(chosen, ["slice", "place"]).select(
        "conv", "slice", "place", F.lit(0).alias("row"), *[F.lit(None).alias(c) for c in ("turn", "role", "text")], F.lit(True).alias("live"),
        F.concat(audit, F.when(F.col("last"), F.element_at(F.array(F.lit(""), F.lit("II"), F.lit("I"), F.lit("")), F.col("exit") + 1))
                 .otherwise("")).alias("audit"), "blank", "duplicate", "truncated", "total",
    )
    rows = open_rows.select("conv", "slice", "place", F.lit(1).alias("row"), "turn", "role", "text", "live")
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "slice", "place", "row")

    schema = _arrow(record)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        none = (None,) * (len(COUNTS) + 2)
        some, conv = False, None
        tally, replay, letters, audits, counts, cost = _Tally(), Replay(), iter(""), [], [0, 0, 0], 0

        def put(message):
            n, letter, turn, role, text = message
            out.add(_MESSAGE, conv, None, None, turn, role, text, *(None,) * 4, n, letter, *none)

        def close():
            for message in _followed(letters, replay, None, "", "", tally):
                if messages:
                    put(message)
            facts = (tally.gaps(), *counts, tally.illegal, cost, "".join(audits), tally.sha.hexdigest())
            out.add(_DONE, conv, None, None, *(None,) * 9, *facts)

        for batch in each(batches):
            for own, _, _, row, turn, role, text, live, audit, *sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not some or own != conv:
                    if some:
                        close()
                    some, conv = True, own
                    tally, replay, letters, audits, counts, cost = _Tally(), Replay(), iter(""), [], [0, 0, 0], 0
                if not row:  # a segment begins; the letters of the one before are used up
                    *found, total = sums
                    counts, cost, letters = [a + b for a, b in zip(counts, found, strict=True)], total or 0, iter(audit)
                    audits.append(audit)
                elif live:
                    tally.row(turn, role)
                    for message in _followed(letters, replay, turn, role, text, tally):
                        if messages:
                            put(message)
                yield from out.batches()
        if some:
            close()
        yield from out.batches(True)

    return both.mapInArrow(follow, record)


def repair(rows: DataFrame, messages: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Repairs conversations given by rows (conv, turn, role, text, live), such as those of :func:`damaged`.

    Rows of a conversation are taken by turn, null turns first; rows of one turn by role, then by a hash of role and
    text. Rows that are not live only name their conversation. Null roles and texts of live rows are not expected.

    A row's first fault counts: blank (nothing but ASCII white space), duplicate (a row with its role and text came
    before), truncated (the last character that is no white space is not one of ``.!?``). The edits are the cheapest
    that delete all blank and duplicate rows and give role initials ``(s?(ua)+)?``: keep for 0, another role for 1,
    delete for 2, insert an empty message for 5, and 5 for each truncated row that stays; of equally cheap ones those
    with the least letters (K, R, D, I). A role counts by its first character, other ones can only be changed or deleted.

    The first result has one row a conversation, a null one included: conv, gaps (turns missing between the least and
    the largest), blank, duplicate, truncated, illegal (neighbours whose initials are not su, ua, au), cost, audit,
    repaired_sha256 (of the repaired ``role:text``, joined by newlines). The second, with ``messages``, has the repaired
    messages: conv, number (from 1), edit (K, R or I), turn (null if inserted), role, text. A conversation without live
    rows has zeros, an empty audit and no messages. An empty table gives empty tables.

    Rows are sorted over all tasks by conversation, turn, role and hash, so a conversation of any size spreads; those
    within one task are repaired there. Longer ones are cut into segments whose costs from every state to every state
    are put together. Only the hash of such a conversation's text is computed row after row.
    """
    conv, record = _schemas(rows)
    ready = _marked(rows).withColumn("arrival", F.monotonically_increasing_id())
    order = ("conv", "turn", "role", "digest", "arrival")
    sliced = ready.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "role", "text", "live", "digest", "is_blank", "is_cut"
    )
    near = written_table(sliced.mapInArrow(_nearby(record, messages), record), "conversations")
    far = written_table(_far(near.where(F.col("kind") == _OPEN), record, messages), "long-conversations")
    both = near.where(F.col("kind") != _OPEN).unionByName(far)
    summary = both.where(F.col("kind") == _DONE).select("conv", *COUNTS, "audit", "repaired_sha256")
    if not messages:
        return summary, None
    return summary, both.where(F.col("kind") == _MESSAGE).select("conv", "number", "edit", "turn", "role", "text")
