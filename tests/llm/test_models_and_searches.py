"""Factorisation machine and label model against plain versions; the vector searches' bounds; empty tables."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlane.llm import impact, quality, srs, toxicity, vectors
from martlane.llm.common import table


# ------------------------------------------------------- factorisation machine

def machine_and_rows(rows=40):
    rng = np.random.default_rng(1)
    stats = rng.normal(size=(rows, len(quality.STATISTICS)))
    buckets = [rng.choice(quality.BUCKETS, rng.integers(0, 60), replace=False) for _ in range(rows)]
    machine = quality.Machine(np.quantile(stats, np.arange(1, quality.BINS) / quality.BINS, axis=0).T, 0.5)
    machine.w = rng.normal(size=machine.w.shape).astype(np.float32)
    machine.v = rng.normal(0, 0.3, machine.v.shape).astype(np.float32)
    machine.w0 = 0.7
    return machine, stats, buckets


def plain_margin(machine, x):
    """The machine's definition: every pair of features."""
    z = machine.w0 + sum(machine.w[i] * a for i, a in x)
    for p in range(len(x)):
        for q in range(p):
            z += float(machine.v[x[p][0]] @ machine.v[x[q][0]]) * x[p][1] * x[q][1]
    return z


def test_sum_of_squares_identity_equals_all_pairs():
    machine, stats, buckets = machine_and_rows()
    index, value, start = machine.features(stats, buckets)
    got, _ = machine.margin(index, value, start)
    ends = np.append(start[1:], len(index))
    for z, lo, hi in zip(got, start, ends):
        assert abs(z - plain_margin(machine, list(zip(index[lo:hi], value[lo:hi])))) < 1e-2


def test_first_step_follows_the_plain_gradient(monkeypatch):
    """One batch of one epoch: Adagrad on numerically differentiated loss."""
    monkeypatch.setattr(quality, "EPOCHS", 1)
    _, stats, buckets = machine_and_rows(30)
    labels = (stats[:, 0] > 0).astype(float)
    trained = quality.fit(stats, buckets, labels)
    before = quality.Machine(trained.borders, float(labels.mean()))
    before.w0 = float(np.log(before.base / (1 - before.base)))
    index, value, start = before.features(stats, buckets)
    ends = np.append(start[1:], len(index))
    rows = [list(zip(index[a:b], value[a:b])) for a, b in zip(start, ends)]

    def loss():
        z = np.array([plain_margin(before, x) for x in rows], float)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    for feature in np.unique(index)[::97][:5].tolist() + [quality.BUCKETS + 1]:
        base, step = before.w[feature], 1e-2
        before.w[feature] = base + step
        up = loss()
        before.w[feature] = base - step
        slope = (up - loss()) / (2 * step)
        before.w[feature] = base
        moved = trained.w[feature] - base
        assert slope * moved <= 0 and abs(moved + 0.1 * slope / np.sqrt(1e-4 + slope * slope)) < 2e-2


# ----------------------------------------------------------------- label model

def generated_votes(n=6000, seed=3):
    rng = np.random.default_rng(seed)
    hidden = rng.random(n) < 0.3
    fires = np.array([0.8, 0.6, 0.7, 0.5, 0.9])     # given the class
    false = np.array([0.1, 0.05, 0.2, 0.02, 0.3])   # given the other
    rate = np.where(hidden[:, None], fires, false)
    votes = (rng.random((n, 5)) < rate).astype(np.int8)
    twin = votes[:, 2].copy()                         # says what voter 2 says, mostly
    flip = rng.random(n) < 0.05
    twin[flip] = 1 - twin[flip]
    labels = np.where(rng.random(n) < 0.05, ~hidden, hidden).astype(int)   # one in twenty labels is wrong
    return np.column_stack([votes, twin]), hidden, labels, fires, false


def test_label_model_recovers_accuracies_and_correlations():
    votes, hidden, labels, fires, false = generated_votes()
    model = toxicity.LabelModel()
    posterior = model.fit(votes, labels)
    assert abs(model.prior - hidden.mean()) < 0.04
    assert np.abs(model.accuracy[1][:5] - fires).max() < 0.06
    assert np.abs(model.accuracy[0][:5] - false).max() < 0.06
    assert model.correlation[2, 5] > 0.7                       # the twins
    apart = [abs(model.correlation[i, j]) for i in range(5) for j in range(i)]
    assert max(apart) < 0.2
    assert max(model.weight[[2, 5]]) < min(model.weight[[0, 1, 3, 4]])   # twins share their weight
    assert ((posterior > 0.5) == hidden).mean() > max((labels == hidden).mean(), 0.96)


# ------------------------------------------------------------- vector searches

def clustered(n, dims=32, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) + rng.normal(size=(12, dims))[rng.integers(0, 12, n)] * 0.5
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_stable_projections_stop_early_over_blocks():
    x, k = clustered(12_000), 20
    asked = np.arange(0, len(x), 100)
    hits, met = {int(i): [] for i in asked}, []
    floors = np.full(len(asked), float(vectors.NO_FLOOR))
    for lo in range(0, len(x), 4096):
        rows = np.arange(lo, min(lo + 4096, len(x)))
        q, v, s = srs.search_block(x[asked], asked, x[rows], rows, rows, k, floors, met=met)
        for a, b, c in zip(q, v, s):
            hits[int(asked[a])].append((-c, int(rows[b])))
        if lo == 0:
            floors = np.array([-sorted(hits[int(i)])[k - 1][0] for i in asked])
    found = 0
    for i in asked:
        score = x @ x[i]
        score[i] = -np.inf
        found += len({v for _, v in sorted(hits[int(i)])[:k]} & set(np.argsort(-score)[:k].tolist()))
        assert all(abs(-s - x[v] @ x[i]) < 1e-12 for s, v in hits[int(i)])
    assert found >= 0.9 * k * len(asked)
    assert sum(met) < 0.6 * len(asked) * len(x)                 # the test fires


def test_search_memory_is_bounded():
    x = clustered(8192, 64)
    asked = np.arange(2565)
    tracemalloc.start()
    srs.search_block(x[asked], asked, x, np.arange(len(x)), np.arange(len(x)), 20, np.full(len(asked), float(vectors.NO_FLOOR)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6


@pytest.mark.parametrize("known", [False, True])
def test_impact_search_is_exact_with_and_without_floors(known):
    rng = np.random.default_rng(5)
    x = np.floor(64 * clustered(3000, 24, 6)).astype(float)
    x[100:140] = x[100]                                         # many ties
    ids = rng.permutation(len(x) // 2).repeat(2)                # every id twice
    asked = np.arange(0, len(x), 60)
    scores = (x[asked] @ x.T).astype(np.int64)
    scores[np.arange(len(asked)), asked] = -(1 << 60)
    want = [sorted((-int(s), int(i), r) for r, (s, i) in enumerate(zip(row, ids)))[:20] for row in scores]
    floors = np.array([-w[-1][0] if known else vectors.NO_FLOOR for w in want])
    q, v, s = impact.search_block(x[asked], asked, x, ids, np.arange(len(x)), 20, floors)
    got = [sorted((-int(c), int(ids[b]), int(b)) for a, b, c in zip(q, v, s) if a == i) for i in range(len(asked))]
    assert [[w[:2] for w in g] for g in got] == [[w[:2] for w in g] for g in want]


# ---------------------------------------------------------------- empty tables

def test_empty_tables_of_the_other_operators(spark):
    docs = table(spark, SF_SMALL, "documents").filter("false")
    labels = table(spark, SF_SMALL, "labels")
    assert quality.classify(docs, labels).count() == 0 and toxicity.classify(docs, labels).count() == 0
    assert quality.keep_good(docs, labels).count() == 0 and toxicity.drop_toxic(docs, labels).count() == 0
    none = table(spark, SF_SMALL, "embeddings").filter("false")
    assert srs.nearest(none, F.col("id") % 20 == 0).count() == 0
    assert impact.top_k(none, F.col("id") % 20 == 0).count() == 0


def test_transducer_of_an_empty_table(spark):
    pytest.importorskip("public_tokenizers")
    from martlane.llm import pieces, transducer
    docs = table(spark, SF_SMALL, "documents").filter("false")
    assert transducer.round_trip(docs, pieces.default_path()).count() == 0


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifiers_on_ties_and_repeated_rows(spark, kind):
    module = quality if kind == "quality" else toxicity
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    twice = docs.unionByName(docs.limit(30))
    got = module.classify(twice, labels).collect()
    assert len(got) == docs.count() + 30
    by_id = {}
    for r in got:
        assert by_id.setdefault(r.doc_id, (r.held_out, r.score, r.predicted)) == (r.held_out, r.score, r.predicted)
    assert Counter(r.predicted == (r.score >= 0.3) for r in got) == {True: len(got)}
