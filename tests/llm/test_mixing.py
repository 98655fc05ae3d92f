"""Mixing against exact targets and bounds."""

import numpy as np
import pytest

from sheafspark.llm import mixing, queries


def slow_targets(sizes):
    """Shares by weight; what is above three times a source's size goes round again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, stopped = float(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            return stopped
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: 3.0 * sizes[s] for s in free if share[s] > 3.0 * sizes[s]}
        if not above:
            return stopped | share
        stopped |= above


def check(rows, texts_by_id=None):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 3
    targets = slow_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s], (s, taken[s], t)
    return targets, taken


@pytest.mark.parametrize("block", [20, 300, 5000])
def test_mix_meets_targets(documents, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    random = np.random.default_rng(block)
    texts = ["w " * int(n) for n in random.pareto(1.2, 1500) * 20 + 1]
    sources = random.choice(["é", "b", "Z", "a", "tiny", "zz"], 1500, p=[0.4, 0.3, 0.1, 0.1, 0.01, 0.09]).tolist()
    docs = documents(texts, sources=[None if s == "zz" else s for s in sources])
    rows = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1500))
    targets, taken = check(rows)
    assert block < 5000 or all(abs(taken[s] - t) <= 2 for s, t in targets.items())
    again = mixing.mix(docs).collect()
    assert {r.doc_id: r.copies for r in rows} == {r.doc_id: r.copies for r in again}


def test_a_step_keeps_both_totals():
    flight = mixing.Flight(7)
    random = np.random.default_rng(7)
    rows = [(i, float(random.random()), float(random.integers(1, 50))) for i in range(400)]
    decided = {}
    for row in rows:
        decided.update(flight.add(*row, landing=False))
    assert len(flight.open) <= 2 and set(decided.values()) <= {0.0, 1.0}
    ends = decided | {r: p for r, p, _ in flight.open}
    assert sum(ends.values()) == pytest.approx(sum(p for _, p, _ in rows))
    assert sum(ends[r] * s for r, _, s in rows) == pytest.approx(sum(p * s for _, p, s in rows))


def test_expected_probabilities_stay():
    hits = np.zeros(12)
    p = np.linspace(0.1, 0.9, 12)
    for seed in range(3000):
        flight = mixing.Flight(seed)
        ends = {}
        for i in range(12):
            ends.update(flight.add(i, float(p[i]), float(1 + i % 5), landing=False))
        ends.update({r: q for r, q, _ in flight.open})
        hits += np.array([ends[i] for i in range(12)])
    assert np.abs(hits / 3000 - p).max() < 0.04


def test_odd_rows(odd_documents, no_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count() and rows[0].score == "own"
    check(rows)
    assert all(r.size == len((r.text or "").encode().split()) for r in rows)
    assert all(r.copies == 0 for r in rows if not r.size)
    assert mixing.mix(no_documents).collect() == []


def test_query(spark, sf_dir):
    rows = queries.op5_mixing(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.size == len(docs[r.doc_id].text.encode().split()) and r.taken <= 3 * r.size for r in rows)
