from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import mixing
from tests.llm.cases import SCHEMA, documents, odd_rows


def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again what is over a limit until nothing is."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        free -= over
    return out


def test_targets_stop_at_their_limit(spark):
    sizes = {"a": 10, "b": 10_000, "c": 7, "d": 300, "": 50, None: 900}
    units = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(units).collect()}
    assert found == pytest.approx(filled(sizes)) and sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), None, f"s{min(i % 9, 4)}") for i in range(900)]
    mixed = mixing.mix(documents(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    for r in mixed:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - target[s]) <= 24 for s in target)
    assert sum(taken.values()) <= sum(r["size"] for r in mixed)
    assert sorted(map(tuple, mixing.mix(documents(spark, rows)).collect())) == sorted(map(tuple, mixed))


def test_odd_rows_and_columns(spark):
    docs = documents(spark, odd_rows())
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(odd_rows()) and sum(r["doc_id"] == 7 for r in rows) == 3
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)
    out = mixing.mixed_documents(docs)
    assert out.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    assert {tuple(r) for r in out.select("doc_id", "copies").collect() if r["doc_id"] == 10} <= {(10, 1), (10, 2), (10, 3)}


def test_repeated_rows_are_taken_one_by_one(spark):
    same = [(1, "w " * 50, None, "a")] * 40
    rows = same + [(2 + i, "w " * (40 + i), None, "b") for i in range(40)] + [(None, "x " * 9, None, "c")] * 30
    docs = documents(spark, rows)
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 80 for s in target) and taken["a"] > 1000
    out = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        out[r["source"]] += len(r["text"].split()) * r["copies"]
    assert out == taken


def test_no_rows_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = mixing.mix(documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(r["target"], r["copies"]) for r in empty] == [(0.0, 0), (0.0, 0)]


def test_main_path_has_no_python(spark):
    docs = documents(spark, odd_rows()).filter(F.col("doc_id") > 0)
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
