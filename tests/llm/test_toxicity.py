"""Toxicity: gradients against differences, scores against a plain loop, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import toxicity
from tests.llm import cases


def plain_logit(p, window):
    """One window, word by word."""
    k = toxicity.HIDDEN
    inputs = [toxicity.Spelling([w]).inputs(p)[0] for w in window]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    sides = []
    for d, order in ((0, range(len(window))), (1, reversed(range(len(window))))):
        h, states = np.zeros(k), {}
        for t in order:
            x, a = inputs[t] @ p["into"][d] + p["bias"][d], h @ p["own"][d]
            reset, stay = sigmoid(x[:k] + a[:k]), sigmoid(x[k : 2 * k] + a[k : 2 * k])
            h = stay * h + (1 - stay) * np.tanh(x[2 * k :] + reset * a[2 * k :])
            states[t] = h
        sides.append(states)
    both = [np.concatenate([sides[0][t], sides[1][t]]) for t in range(len(window))]
    look = np.exp([b @ p["look"] for b in both])
    return sum(w * b for w, b in zip(look / look.sum(), both, strict=True)) @ p["out"] + p["base"][0]


def network(seed=3, scale=1.0):
    p = {k: v.astype(np.float64) for k, v in toxicity.started(seed).items()}
    p["words"] *= 10
    p["grams"] *= 10
    return p | {"scale": np.array([scale, 0.2])}


@pytest.mark.parametrize("n", [1, 3, 63, 64, 65, 112, 113, 400])
def test_scores_are_the_largest_of_all_windows(n):
    p = network()
    text = cases.prose(n, n)
    found = text.split()
    windows = [found[b : b + 64] for b in (range(0, n - 64, 48) if n > 64 else [0])] + ([found[-64:]] if n > 64 else [])
    want = max(plain_logit(p, w) for w in windows)
    got = toxicity.Scorer(p, 0.1).scores(iter([text, None, text, "..."]))
    assert got == pytest.approx([1 / (1 + math.exp(-want - 0.2)), 0.1, 1 / (1 + math.exp(-want - 0.2)), 0.1], abs=1e-4)


def test_a_small_memory_of_words_changes_nothing(monkeypatch):
    texts = [cases.prose(i, 5 + 37 * i) for i in range(20)]
    want = toxicity.Scorer(network(), 0.1).scores(iter(texts))
    monkeypatch.setattr(toxicity, "_KNOWN", 50)
    assert toxicity.Scorer(network(), 0.1).scores(iter(texts)) == pytest.approx(want, abs=1e-5)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 700), st.integers(50, 400))
def test_windows_of_segments_are_those_of_the_whole_text(n, size):
    text = " ".join(f"w{i}" for i in range(n))
    old = toxicity._SEGMENT, toxicity._SLICE
    toxicity._SEGMENT, toxicity._SLICE = 96, size
    try:
        got = [tuple(found[b : b + 64]) for found, at in toxicity.segments(text) for b in at]
    finally:
        toxicity._SEGMENT, toxicity._SLICE = old
    found = text.split()
    assert got == [tuple(found[b : b + 64]) for b in toxicity.places(n)]


def test_gradients():
    rnd = np.random.default_rng(0)
    vocabulary = ["idiot", "the", "of", "ä", "trashy", "x" * 20]
    windows = rnd.integers(0, 6, (4, 9))
    windows[1, 5:] = -1
    windows[2, 1:] = -1
    label, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 3])
    p = network()
    _, grad = toxicity.loss_gradients(p, vocabulary, windows, label, weight)
    for name, g in grad.items():
        flat = np.flatnonzero(g)
        for at in rnd.choice(flat, min(12, len(flat)), replace=False):
            x = p[name].reshape(-1)
            was, found = x[at], []
            for step in (1e-4, -1e-4):
                x[at] = was + step
                found.append(toxicity.loss_gradients(p, vocabulary, windows, label, weight)[0])
            x[at] = was
            assert (found[0] - found[1]) / 2e-4 == pytest.approx(g.reshape(-1)[at], rel=1e-2, abs=1e-5), name


def test_calibration_gives_the_share():
    rnd = np.random.default_rng(1)
    label = (rnd.random(4000) < 0.5).astype(float)
    z = 4 * label - 1 + rnd.standard_normal(4000)
    a, b = toxicity.calibrated(z, label, 0.1)
    scores = 1 / (1 + np.exp(-(a * z + b)))
    assert 0.1 * scores[label == 1].mean() + 0.9 * scores[label == 0].mean() == pytest.approx(0.1, abs=0.01)


def corpus(n=800):
    """Toxic texts have some words of a list, or words with a certain beginning; both are rare among the words."""
    rnd, rows, labels = random.Random(2), [], []
    for i in range(n):
        found = cases.prose(i, rnd.randint(30, 300)).split()
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(max(2, len(found) // 40)):
                found[rnd.randrange(len(found))] = rnd.choice(["Idiot", "moron", "zkb" + cases.prose(rnd.randrange(10**6), 1)])
        rows.append((i, " ".join(found), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = cases.documents(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "1 as quality", "'x' as text")
    found = toxicity.predict(docs, toxicity.train(docs, known)).collect()
    want = dict(labels)
    out = [r for r in found if r["held_out"]]
    assert [r["held_out"] for r in found] == [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in found]
    caught = [r["predicted"] for r in out if want[r["doc_id"]]]
    clean = [r["predicted"] for r in out if not want[r["doc_id"]]]
    assert sum(caught) >= 0.9 * len(caught) and sum(clean) <= 0.1 * len(clean)
    # labels of held-out documents are not read
    other = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels], "doc_id long, toxic int")
    again = toxicity.predict(docs, toxicity.train(docs, other)).collect()
    assert sorted((r["doc_id"], r["score"]) for r in again) == sorted((r["doc_id"], r["score"]) for r in found)


def test_odd_rows(spark):
    rows, labels = corpus(60)
    rows = [*cases.odd_rows(), *[(100 + i, *r) for i, *r in rows]]
    docs = cases.documents(spark, rows)
    known = spark.createDataFrame([(100 + i, t) for i, t in labels] + [(1, 1), (7, 0), (7, None), (None, 1), (100, 1)], "doc_id long, toxic int")
    found = toxicity.predict(docs, toxicity.train(docs, known, rounds=2)).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2, 3, 12)}) == 1
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(0, 1), (1, 1)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = cases.documents(spark, corpus(5)[0])
    found = toxicity.predict(docs, toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    assert {r["score"] for r in found} == {float(bool(labels and labels[0][1]))}


def test_no_rows(spark):
    docs = cases.documents(spark, [])
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity.predict(docs, toxicity.train(docs, labels)).count() == 0
