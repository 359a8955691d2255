"""Ranked search against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import lexical_search
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t, *_ in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for i, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


def searched(spark, docs, items, **settings):
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as block", "'x' as doc_id")
    return [tuple(r) for r in lexical_search.search(cases.documents(spark, docs), frame, **settings).collect()]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def corpus(seed=0, n=300):
    return [(i, cases.prose(seed + i % 200, 5 + i % 60, "abcde"), "en", "s") for i in range(n)]


ITEMS = [(1, cases.prose(3, 20, "abcde")), (2, "a b c a a"), (3, None), (4, "..."), (5, "word nothere"), (5, cases.prose(9, 30, "abcde")), (None, "É 漢字 the")]


@pytest.mark.parametrize("postings, block", [(1 << 21, 1 << 22), (400, 50)])
def test_against_brute_force(spark, monkeypatch, postings, block):
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    docs = [*cases.odd_rows(), *corpus()]
    assert sorted(searched(spark, docs, ITEMS, block_chars=block), key=key) == sorted(brute_force(docs, ITEMS), key=key)


def test_copies_take_ranks_by_id(spark):
    docs = [(i, "alpha beta gamma", "en", "s") for i in reversed(range(3000))] + [(5000 + i, cases.prose(i, 30), "en", "s") for i in range(4000)]
    found = sorted(r[1:3] for r in searched(spark, docs, [(1, "beta")]))
    assert found == [(i + 1, i) for i in range(20)]


def test_no_rows(spark):
    assert searched(spark, [], ITEMS) == []
    assert searched(spark, corpus(n=5), []) == []
    assert searched(spark, corpus(n=5), [(1, None)]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 9)), min_size=1, max_size=6, unique_by=lambda x: x[0]), min_size=1, max_size=40), st.data())
def test_range_maxima_and_exact_lists(rows, data):
    rows = [sorted(r) for r in rows]
    lengths = np.array([sum(n for _, n in r) for r in rows])
    starts = np.cumsum([0, *map(len, rows)])[:-1]
    part = lexical_search.Part([[i] for i in range(len(rows))], lengths, starts, np.array([t for r in rows for t, _ in r], np.int32), np.array([n for r in rows for _, n in r], np.int32), len(rows), int(lengths.sum()))
    at = data.draw(st.integers(0, len(part.terms) - 1))
    low, high = sorted((data.draw(st.integers(part.begin[at], part.begin[at + 1])), data.draw(st.integers(part.begin[at], part.begin[at + 1]))))
    place, value = part.best(np.array([low]), np.array([high]))
    assert value[0] == part.impact[low:high].max(initial=0) and (low == high or part.impact[place[0]] == value[0])
    weights = {t: data.draw(st.integers(0, 5)) for t in range(1, 8)}
    scores = {}
    for t, w in weights.items():
        if t in part.terms:
            i = list(part.terms).index(t)
            for p in range(part.begin[i], part.begin[i + 1]):
                scores[int(part.doc[p])] = scores.get(int(part.doc[p]), 0) + w * int(part.impact[p])
    k = data.draw(st.integers(1, 5))
    found = []
    part.search(weights, found, k)
    assert sorted(((e[0], e[3]) for e in found), key=lambda e: (-e[0], e[1])) == sorted(((s, d) for d, s in scores.items() if s > 0), key=lambda e: (-e[0], e[1]))[:k]


def test_few_documents_are_scored(spark):
    rnd = np.random.default_rng(1)
    rows = [sorted(set(np.minimum(rnd.zipf(1.3, 30), 5000).tolist())) for _ in range(20_000)]
    lengths, starts = np.array(list(map(len, rows))), np.cumsum([0, *map(len, rows)])[:-1]
    term = np.array([t for r in rows for t in r], np.int32)
    part = lexical_search.Part([[i] for i in range(len(rows))], lengths, starts, term, np.ones(len(term), np.int32), len(rows), int(lengths.sum()))
    weight = {t: int(1000 * math.log(len(rows) / n)) for t, n in Counter(term.tolist()).items()}
    assert part.search({t: weight[t] for t in rows[7]}, [], 20) < len(rows) / 5
