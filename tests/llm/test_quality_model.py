import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import quality_model as qm
from tests.llm.cases import documents, odd_rows, prose

LABELS = "doc_id long, good int"


def plain_model(texts):
    """Interpolated modified Kneser-Ney over tuples of symbols, straight from its definition."""
    of = qm._symbols()
    counts = [Counter() for _ in range(qm.ORDER + 1)]
    for text in texts:
        symbols = [0] * (qm.ORDER - 1) + [int(of[b]) for b in text.encode()]
        for i in range(len(symbols) - qm.ORDER + 1):
            counts[qm.ORDER][tuple(symbols[i : i + qm.ORDER])] += 1
    for k in range(qm.ORDER - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1
    sizes, totals, kinds = {}, {}, {}
    for k in range(1, qm.ORDER + 1):
        of_counts = Counter(counts[k].values())
        n1, n2, n3, n4 = (of_counts[i] for i in (1, 2, 3, 4))
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            sizes[k] = [d if 0 < d < i else 0.5 * i for i, d in enumerate(raw, 1)]
        else:
            sizes[k] = [0.5] * 3
        totals[k], kinds[k] = Counter(), defaultdict(Counter)
        for gram, n in counts[k].items():
            totals[k][gram[:-1]] += n
            kinds[k][gram[:-1]][min(n, 3)] += 1

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / 64
        total = totals[k][gram[:-1]]
        if not total:
            return p(gram[1:])
        n = counts[k][gram]
        weight = sum(sizes[k][i - 1] * m for i, m in kinds[k][gram[:-1]].items()) / total
        return (n - sizes[k][min(n, 3) - 1] if n else 0) / total + weight * p(gram[1:])

    def perplexity_sum(text):
        symbols = [0] * (qm.ORDER - 1) + [int(of[b]) for b in text.encode()]
        return -sum(math.log(max(p(tuple(symbols[i : i + qm.ORDER])), 1e-12)) for i in range(len(symbols) - qm.ORDER + 1))

    return perplexity_sum


def corpus():
    rows = [(i, prose(i, 30 + i % 7, "etaoin").capitalize() + ".\nÉté 2020!", ["en", "de", None][i % 3], None) for i in range(120)]
    junk = [(200 + i, "# $$ | ZZ!! " * (5 + i), "en", None) for i in range(10)]
    return rows + junk, [(i, 1) for i in range(100)] + [(3, 0), (200, 0), (5, None), (None, 1)]


def test_scores_are_those_of_the_definition(spark):
    rows, labels = corpus()
    docs, trusted = documents(spark, rows), qm.trusted_ids(spark.createDataFrame(labels, LABELS))
    model = qm.train(docs, trusted)
    ids = {i for i, g in labels if g == 1} - {3, None}
    plain = plain_model([t for i, t, _, _ in rows if i in ids])
    table = qm.costs(model).astype(np.float32)
    assert np.allclose(np.exp(-table / qm._SCALE).reshape(-1, 64).sum(axis=1), 1, atol=2e-3)  # each context's probabilities sum to 1
    got = {r["doc_id"]: r for r in qm.scored(docs, model).collect()}
    for i, text, _, _ in rows:
        assert got[i]["n"] == len(text.encode()) and got[i]["nll"] == pytest.approx(plain(text), rel=5e-4)


def test_thresholds_and_decisions(spark):
    rows, labels = corpus()
    docs, frame = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    found = {r["doc_id"]: r for r in qm.classify(docs, frame, quantile=0.9).collect()}
    trusted = {i for i, g in labels if g == 1} - {3, None}
    for lang in {r[2] for r in rows}:
        own = sorted(found[i]["perplexity"] for i, _, l, _ in rows if l == lang and i in trusted)
        limit = own[math.ceil(0.9 * len(own)) - 1]
        for i, _, l, _ in rows:
            if l == lang:
                assert found[i]["threshold"] == pytest.approx(limit, rel=1e-6) and found[i]["kept"] == (found[i]["perplexity"] <= limit + 1e-9)
    assert not any(found[i]["kept"] for i in range(200, 210))
    kept = qm.good_documents(docs, frame, quantile=0.9)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["kept"]}


def test_odd_rows_and_no_rows(spark):
    labels = spark.createDataFrame([(10, 1), (9, 1), (4, 1)], LABELS)
    rows = qm.classify(documents(spark, odd_rows()), labels).collect()
    assert len(rows) == len(odd_rows())
    assert all((r["perplexity"] is None) == (r["n_symbols"] == 0) and (r["kept"] or r["n_symbols"] == 0 or r["threshold"]) for r in rows)
    nothing = spark.createDataFrame([], LABELS)
    assert {r["kept"] for r in qm.classify(documents(spark, odd_rows()), nothing).collect() if r["n_symbols"]} == {True}
    assert qm.good_documents(documents(spark, odd_rows()), nothing).count() == sum(bool(r[1]) for r in odd_rows())
    assert qm.classify(documents(spark, []), labels).count() == 0


def test_many_texts_are_spelt_at_once(monkeypatch):
    monkeypatch.setattr(qm, "_FLUSH", 40)
    of, values = qm._symbols(), np.random.default_rng(2).integers(0, 1 << 16, 1 << 24).astype(np.uint16)
    texts = ["a ", "b", "漢字 ", "x" * 100, "\0\0 ", "été ", " "]
    assert list(qm.gram_sums(texts, of, values)) == [int(values[qm.grams(t, of)].sum(dtype=np.int64)) for t in texts]
    assert len(qm.gram_sums([], of, values)) == 0
