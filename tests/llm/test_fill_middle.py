"""Fill-in-the-middle against cuts made from a list of all tokens."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.llm import fill_middle
from tests.llm import cases


def expected(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(tokens), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = st.text(st.sampled_from("aZé漢😀 \n\t.<PSM>\x00\x0b|[`{@"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.one_of(st.none(), st.integers(-5, 2**62)))
def test_small_texts(text, doc_id):
    assert fill_middle.rearranged(doc_id, text) == expected(doc_id, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=300), st.integers(1, 100))
def test_pieces_stay_within_their_error(steps, error):
    offsets = np.cumsum(steps)
    firsts, slopes = fill_middle.pieces(offsets, error)
    for first, end, slope in zip(firsts, [*firsts[1:], len(offsets)], slopes, strict=True):
        guess = offsets[first] + slope * (np.arange(first, end) - first)
        assert np.abs(guess - offsets[first:end]).max() <= error + 1e-6


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_every_rank_is_exact_across_slices(monkeypatch, size):
    monkeypatch.setattr(fill_middle, "SLICE", size)
    text = cases.prose(3, 300) + "x" * 500 + "é漢" * 50 + "... " * 100 + "end"
    starts = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    index = fill_middle.RankIndex(text)
    assert index.n_tokens == len(starts)
    assert [index.offset(r) for r in range(len(starts) + 1)] == [*starts, len(text)]


def test_long_text_has_few_pieces():
    text = cases.prose(1, 200_000)
    index = fill_middle.RankIndex(text)
    assert len(index.first) < index.n_tokens / 100 and index.rest.dtype == np.int8


def test_odd_rows_and_round_trip(spark):
    rows = [*cases.odd_rows(), *[(100 + i, cases.prose(i, 40) + "<" * (i % 3), "en", "s") for i in range(60)], (200, "a <M> inside", "en", "s")]
    made = fill_middle.transform(cases.documents(spark, rows)).withColumn("back", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r[:1]) + tuple(str(x) for x in r[1:])
    assert sorted((tuple(r[:6]) for r in made), key=key) == sorted([(i, *expected(i, t)) for i, t, _, _ in rows], key=key)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}
    texts = {}
    for i, t, _, _ in rows:
        texts.setdefault(i, set()).add(t or "")
    assert all(r["back"] in texts[r["doc_id"]] for r in made)


def test_no_rows(spark):
    assert fill_middle.transform(cases.documents(spark, [])).count() == 0
