"""Exact and near duplicates against brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import connect, duck_rows, spark_rows

from sheafspark.llm import exact_dedup as exact
from sheafspark.llm import queries, simhash
from sheafspark.llm.components import connected_components


def lower(text):
    return (text or "").encode().lower()


def test_exact_query_equals_sql(spark, sf_dir):
    assert spark_rows(queries.op2_exact_dedup(spark, sf_dir)) == duck_rows(connect(sf_dir), queries.OP2_SQL)


def test_exact_odd_rows(odd_documents, no_documents):
    rows = exact.exact_dedup(odd_documents).collect()
    assert len(rows) == odd_documents.count() and rows[0].score == "own"
    groups = {}
    for r in rows:
        assert r.text_sha256 == hashlib.sha256(lower(r.text)).hexdigest()
        groups.setdefault(lower(r.text), []).append(r)
    for group in groups.values():
        ids = [r.doc_id for r in group]
        top = max((i for i in ids if i is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in group} == {(top, len(group))}
        assert [r.doc_id for r in group if r.kept] == [top]
    assert exact.exact_dedup(no_documents).collect() == []


@pytest.mark.parametrize("words", [1, 2, 1 << 12])
def test_a_small_filter_only_lets_more_rows_move(documents, monkeypatch, words):
    monkeypatch.setattr(exact, "MAX_WORDS", words)
    texts = [f"text {i % 90}" if i < 300 else f"single {i}" for i in range(600)]
    rows = exact.exact_dedup(documents(texts)).collect()
    want = {t: max(i for i, x in enumerate(texts) if x == t) for t in texts}
    assert {r.doc_id: (r.keep_id, r.kept) for r in rows} == {i: (want[t], want[t] == i) for i, t in enumerate(texts)}


def test_the_filter_misses_no_repeat():
    random = np.random.default_rng(5)
    digests = [random.bytes(32) for _ in range(2000)]
    repeated = digests[:300] + digests[:5] * 20
    left, right = exact.RepeatFilter(500), exact.RepeatFilter(500)
    left.add(pa.array(digests[:1000] + repeated[150:], pa.binary()))
    right.add(pa.array(digests[1000:] + repeated[:150], pa.binary()))
    left.merge(0, right.once, right.twice)
    at, mask = exact._places(pa.array(repeated, pa.binary()), 500)
    assert ((left.twice[at] & mask) == mask).all()
    at, mask = exact._places(pa.array(digests[400:], pa.binary()), 500)
    assert ((left.twice[at] & mask) == mask).mean() < 0.2


def slow_print(text):
    words = lower(text).split()
    n = len(words)
    shingles = [b" ".join(words[i : i + 4]) for i in range(n - 3)] if n >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_components(prints, ids):
    """The smallest id reachable over links of at most 4 bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(j)] = find(i)
    known = [(find(i), ids[i]) for i in range(len(ids)) if ids[i] is not None]
    return [min((x for r, x in known if r == find(i)), default=None) for i in range(len(ids))]


def test_near_query_equals_brute_force(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = [slow_print(r.text) for r in docs]
    want = slow_components(prints, [r.doc_id for r in docs])
    got = sorted(tuple(r) for r in queries.op8_simhash(spark, sf_dir).collect())
    assert got == [(r.doc_id, f"{p:016x}", c) for r, p, c in zip(docs, prints, want, strict=True)]


def test_near_odd_rows(odd_documents, no_documents):
    rows = odd_documents.collect()
    want = slow_components([slow_print(r.text) for r in rows], [r.doc_id for r in rows])
    key = lambda x: (x[0] is None, x)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(odd_documents).collect()), key=key)
    assert got == sorted(((r.doc_id, c) for r, c in zip(rows, want, strict=True)), key=key)
    kept = simhash.simhash_survivors(odd_documents)
    assert kept.schema == odd_documents.schema and kept.count() == 6  # two components have the key 1
    assert simhash.simhash_groups(no_documents).collect() == [] and simhash.simhash_survivors(no_documents).collect() == []


@pytest.mark.parametrize("compared", [2, 5, 1024])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, compared):
    monkeypatch.setattr(simhash, "COMPARED", compared)
    random = np.random.default_rng(compared)
    prints = set()
    for base in random.integers(0, 2**63, 25).tolist():
        for _ in range(12):  # chains and clusters around a few centres, also inside one block
            high = 64 if random.random() < 0.5 else 21
            base ^= sum(1 << int(b) for b in random.choice(high, random.integers(0, 4), replace=False))
            prints.add(base)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4 for r in links)
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        root[find(r.a)] = find(r.b)
    want = slow_components(prints, list(range(len(prints))))
    smallest = {}
    for i, p in enumerate(signed):
        smallest.setdefault(find(p), i)
    assert [smallest[find(p)] for p in signed] == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(-5, 300), (300, 299), (7, 7)]
    random = np.random.default_rng(1)
    edges = [tuple(random.permutation(e).tolist()) for e in edges]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {-5: -5, 300: -5, 299: -5}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
