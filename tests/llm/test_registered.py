"""Registered queries against their SQL, and the pipeline."""

import re

import pytest

import corpus_pipeline
from corpusflow.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_DIR
from tests.llm.cases import documents, odd_rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(cursor.fetchall())


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, duck):
    names = [d for d, in duck.execute("select column_name from (describe documents)").fetchall()]
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == [*names, "copies"]
    rows = rows.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 50 and {r["copies"] for r in rows} <= {1, 2, 3}
    items = [" ".join(t.split()) for t, in duck.execute("select text from benchmark").fetchall()]
    assert not any(i in " ".join(r["text"].split()) for r in rows for i in items)
    assert not any(re.search(r"(?i:password|token|secret)[\"']? *[:=] *[\"']?[\w.=-]{6}", r["text"]) for r in rows)
    good = dict(duck.execute("select doc_id, quality from labels").fetchall())
    assert sum(good.get(r["doc_id"]) == 0 for r in rows) <= 0.2 * sum(v == 0 for v in good.values())


def written(spark, path, rows):
    """A data folder with these documents, labels for some and one item that a document holds."""
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (9, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "another text under a number that is taken"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_on_odd_rows(spark, tmp_path):
    docs = documents(spark, odd_rows())
    rows = corpus_pipeline.run(spark, written(spark, f"{tmp_path}/odd", odd_rows()))
    assert rows.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    found = rows.collect()
    texts = [r["text"] for r in found]
    assert len(set(texts)) == len(texts) > 0 and all(t and t.strip() for t in texts)  # one of each, none without words
    assert not any(t.startswith("another text") for t in texts) and {r["copies"] for r in found} <= {1, 2, 3}


def test_pipeline_on_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, f"{tmp_path}/none", [])).count() == 0
