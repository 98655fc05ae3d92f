"""Conversation repair against exhaustive search, and against plain strings in place of linked prefixes."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from compare import connect, duck_rows, spark_rows

from sheafspark.llm import audit_paths, conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, live string, copy int"
WHITE = " \t\n\x0b\x0c\r"
ORDER = re.compile(r"(s?(ua)+)?")


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def faults(rows):
    """0 none, 1 blank, 2 duplicate, 3 truncated."""
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(WHITE)
        out.append(1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def exhaustive(rows):
    """(cost, audit, messages) by all ways with at most two insertions at a place."""
    added = [c for n in range(3) for c in itertools.product(("user", "assistant"), repeat=n)]

    def edits(row, fault):
        yield 2, "D", []
        if fault not in (1, 2):
            extra = 5 * (fault == 3)
            yield extra, "K", [(row[2], row[3])]
            for role in ("user", "assistant"):
                yield 1 + extra, "R", [(role, row[3])]

    steps = [
        [(5 * len(a) + c, "I" * len(a) + e, [(r, "") for r in a] + m) for a in added for c, e, m in edits(row, fault)]
        for row, fault in zip(rows, faults(rows), strict=True)
    ]
    steps.append([(5 * len(a), "I" * len(a), [(r, "") for r in a]) for a in added])
    best = None
    for way in itertools.product(*steps):
        cost, audit = sum(w[0] for w in way), "".join(w[1] for w in way)
        if best is None or (cost, audit) < best[:2]:
            messages = [m for w in way for m in w[2]]
            initials = [r[:1] for r, _ in messages]
            if all(i in ("s", "u", "a") for i in initials) and ORDER.fullmatch("".join(initials)):
                best = cost, audit, messages
    return best


def plain(rows):
    """(cost, audit, messages) by a table of whole strings for every row and state."""
    follow = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    table = {0: (0, "", ())}

    def put(into, state, way):
        into[state] = min(into.get(state, way), way)

    def with_insertions(table):
        out = dict(table)
        for _ in range(3):
            for state, (cost, audit, messages) in list(out.items()):
                role, after = follow[state]
                put(out, after, (cost + 5, audit + "I", (*messages, (role, ""))))
        return out

    for (_, _, role, text), fault in zip(rows, faults(rows), strict=True):
        after = {}
        for state, (cost, audit, messages) in with_insertions(table).items():
            put(after, state, (cost + 2, audit + "D", messages))
            if fault not in (1, 2):
                extra = 5 * (fault == 3)
                to, then = follow[state]
                put(after, then, (cost + 1 + extra, audit + "R", (*messages, (to, text))))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role[:1]))
                if kept is not None:
                    put(after, kept, (cost + extra, audit + "K", (*messages, (role, text))))
        table = after
    cost, audit, messages = min(way for state, way in with_insertions(table).items() if state in (0, 3))
    return cost, audit, list(messages)


def slow(rows, solve=plain):
    """What the query returns for rows (conv, turn, role, text) before damage."""
    out, messages = {}, {}
    after = slow_damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in after if r[0] == conv]
        digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
        turns = {r[1] for r in own} - {None}
        found = faults(own)
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, said = solve(own) if own else (0, "", [])
        text = "\n".join(f"{r}:{t}" for r, t in said)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = (gaps, found.count(1), found.count(2), found.count(3), illegal, cost)
        out[conv] = (conv, *counts, audit, hashlib.sha256(text.encode()).hexdigest())
        messages[conv] = said
    return out, messages


def got(df):
    names = ("conv_id", *conversations.COUNTS, "audit", "repaired_sha256")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def table_rows(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return [tuple(r) for r in table.collect()]


def test_query_equals_brute_force(spark, sf_dir):
    assert got(queries.op13_conversations(spark, sf_dir)) == slow(table_rows(spark, sf_dir))[0]


def test_query_equals_sql(spark, sf_dir):
    assert spark_rows(queries.op13_conversations(spark, sf_dir)) == duck_rows(connect(sf_dir), queries.OP13_SQL)


def made(random, conversations, most, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["Yes.", "No!", "Why?", "so", "", " \n", None, "a.b", "Well"]
    rows = []
    for conv in conversations:
        for turn in range(random.randint(1, most)):
            turn = None if random.random() < 0.1 else turn * random.choice((1, 1, 1, 2))
            rows.append((conv, turn, random.choice(roles), random.choice(texts)))
    return rows


@pytest.mark.parametrize("bounds", [{}, {"LOCAL_ROWS": 3, "SEGMENT_ROWS": 2}, {"LOCAL_ROWS": 0, "SEGMENT_ROWS": 5, "_OUT_ROWS": 1}])
def test_made_conversations(spark, stored, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(conversations, name, value)
    chance = random.Random(len(bounds))
    rows = made(chance, [None, *range(60)], 9)
    rows += [(77, turn, chance.choice(("user", "assistant")), f"{chance.choice('abc')}{chance.randrange(40)}.") for turn in range(300)]
    rows += rows[:20]  # repeated rows
    chance.shuffle(rows)
    summary, messages = conversations.repair(conversations.damaged(stored([(*r, "x", 1) for r in rows], SCHEMA)))
    wanted, said = slow(rows)
    assert got(summary.withColumnRenamed("conv", "conv_id")) == wanted
    found = {}
    for r in sorted(messages.collect(), key=lambda r: r.number):
        found.setdefault(r.conv, []).append((r.role, r.text))
        assert r.number == len(found[r.conv])
    assert found == {conv: m for conv, m in said.items() if m}


def test_no_rows(spark, stored):
    summary, messages = conversations.repair(conversations.damaged(stored([], SCHEMA)))
    assert summary.collect() == [] and messages.collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    summary, messages = conversations.repair(conversations.damaged(stored([(dropped, 0, "user", "x", "", 1)], SCHEMA)))
    assert tuple(summary.first()) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert messages.collect() == []


def kinds_of(rows):
    return [audit_paths.row_kind(r[2][:1], f in (1, 2), f == 3) for r, f in zip(rows, faults(rows), strict=True)]


def test_program_equals_exhaustive_search():
    chance = random.Random(7)
    for _ in range(60):
        rows = slow_damage(made(chance, [1], 3))[:3]
        cost, audit, messages = exhaustive(rows)
        assert plain(rows) == (cost, audit, messages)
        assert audit_paths.cheapest(kinds_of(rows)) == (cost, audit)


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3, 1])
def test_program_equals_plain_strings_whatever_the_hash(monkeypatch, modulus):
    monkeypatch.setattr(audit_paths, "_MOD", modulus)  # with few hashes all equal ones must be verified
    chance = random.Random(modulus)
    for _ in range(150):
        rows = slow_damage(made(chance, [1], 25, ("user", "assistant", "system", "tool")))
        if rows:
            assert audit_paths.cheapest(kinds_of(rows)) == plain(rows)[:2]


def test_segments_equal_the_whole():
    chance = random.Random(11)
    for _ in range(100):
        kinds = [chance.choice((0, 1, 2, 3, 3, 4, 5, 5, 6, 7, 8)) for _ in range(chance.randint(1, 30))]
        chain, audits, start = audit_paths.Chain(), [], 0
        while start < len(kinds):
            stop = start + chance.randint(1, 6)
            paths = [audit_paths.Paths(s) for s in range(4)]
            for p in paths:
                for kind in kinds[start:stop]:
                    p.row(kind)
            held = [h for p in paths for h in p.best]
            chain.add([h and h[0] for h in held], [r for p in paths for r in p.ranks()])
            audits.append([h and h[1].letters() for h in held])
            start = stop
        cost, states = chain.states()
        whole = "".join(a[4 * s + t] for a, (s, t) in zip(audits, itertools.pairwise(states), strict=True))
        assert (cost, whole + audit_paths.CLOSING[states[-1]][1]) == audit_paths.cheapest(kinds)
