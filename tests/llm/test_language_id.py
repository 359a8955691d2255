import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import language_id as li
from tests.llm.cases import documents, odd_rows, prose


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = li.predict(docs, li.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    right = [r for r in held if r["lang_pred"] == r["lang"]]
    assert len(held) > 200 and len(right) >= 0.97 * len(held)
    assert abs(sum(r["score"] for r in held) - len(right)) < 0.03 * len(held)  # calibrated


def test_held_out_languages_are_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hidden = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = (sorted(map(tuple, li.predict(d, li.train(d)).collect())) for d in (docs, hidden))
    assert a == b


def test_frequencies_cover_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    df = sum((li.gram_counts(t) > 0).astype(int) for t in texts)
    idf = li.train(docs)["idf"]
    seen = df > 0
    assert np.allclose(idf[seen], np.log((1 + len(texts)) / (1 + df[seen])) + 1e-3, atol=1e-5)


def test_grams_fit_and_temperature():
    counts = li.gram_counts("AbaB")
    assert counts.sum() == 4 + 3 + 2 and np.array_equal(counts, li.gram_counts("abab"))
    at, x = li.weighed(counts, np.ones(li.BUCKETS))
    assert at[-1] == li.BUCKETS and math.isclose((x[:-1] ** 2).sum(), 1)
    rnd = np.random.default_rng(0)
    rows = [(np.array([k % 3, 10 + rnd.integers(50), li.BUCKETS]), np.array([1.0, 0.3, 1.0]), k % 3) for k in range(300)]
    weights = li.fit(rows, 3)
    assert all(int(np.argmax(x @ weights[at])) == y for at, x, y in rows) and (weights[10:60] == 0).mean() > 0.2  # sparse
    scores = rnd.normal(size=(4000, 3))
    labels = np.array([rnd.choice(3, p=p) for p in li.softmax(scores)])
    assert 0.85 < li.temperature(scores, labels) < 1.2 and 4 < li.temperature(scores * 5, labels) < 6


def test_odd_rows_and_no_rows(spark):
    docs = documents(spark, odd_rows())
    rows = li.predict(docs, li.train(docs)).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3, 11, 12)] == ["und"] * 5 and by_id[11]["score"] == 0
    assert by_id[4]["lang_pred"] in {"en", "de", "fr"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in li.predict(unlabelled, li.train(unlabelled)).collect()} == {("und", 0.0)}
    none = documents(spark, [])
    assert li.predict(none, li.train(none)).count() == 0


def test_rows_that_share_an_id_take_one_place_for_each_text(spark, monkeypatch):
    monkeypatch.setattr(li, "FIT", 40)
    monkeypatch.setattr(li, "CALIBRATE", 10)
    rows = [(None, "one text under no id, again and again", "en", None)] * 300
    rows += [(i, prose(i, 20), ["en", "de"][i % 2], None) for i in range(400)]
    fitted, whole = [], li.fit

    def seen(examples, *args, **settings):
        fitted.extend(examples)
        return whole(examples, *args, **settings)

    monkeypatch.setattr(li, "fit", seen)
    li.train(documents(spark, rows))
    assert len(fitted) == 40 and len({(at.tobytes(), x.tobytes()) for at, x, _ in fitted}) == 40


def test_training_against_a_plain_loop():
    """Follow-the-regularised-leader with an elastic net, number by number, on TF-IDF values from plain counts of n-grams."""
    texts = [(prose(10 * y + i, 12, letters), y) for y, letters in enumerate(("etaoin", "schrub", "lemzwy")) for i in range(6)]
    count = li.gram_counts

    def place(gram):
        """What a gram adds to the counts of its parts."""
        own = count(gram) - (count(gram[:-1]) + count(gram[1:]) - (count(gram[1:-1]) if len(gram) == 3 else 0) if len(gram) > 1 else 0)
        return int(np.flatnonzero(own)[0])

    places = {text[i : i + size]: None for text, _ in texts for size in (1, 2, 3) for i in range(len(text) - size + 1)}
    places = {gram: place(gram) for gram in places}
    examples = []
    for text, y in texts:
        counts = {}
        for size in (1, 2, 3):
            for i in range(len(text) - size + 1):
                at = places[text[i : i + size]]
                counts[at] = counts.get(at, 0) + 1
        values = {at: 1 + math.log(n) for at, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in values.values()))
        examples.append(({at: v / norm for at, v in values.items()} | {li.BUCKETS: 1.0}, y))
    z, n = {}, {}

    def weight(at, c):
        zz, nn = z.get((at, c), 0.0), n.get((at, c), 0.0)
        return 0.0 if abs(zz) <= li.L1 else -(zz - math.copysign(li.L1, zz)) / ((li.BETA + math.sqrt(nn)) / li.ALPHA + li.L2)

    order = np.random.default_rng(42)
    for _ in range(li.EPOCHS):
        for k in order.permutation(len(examples)):
            x, y = examples[k]
            w = {(at, c): weight(at, c) for at in x for c in range(3)}
            scores = [sum(v * w[at, c] for at, v in x.items()) for c in range(3)]
            total = sum(math.exp(s) for s in scores)
            for c in range(3):
                error = math.exp(scores[c]) / total - (c == y)
                for at, v in x.items():
                    g = v * error
                    step = (math.sqrt(n.get((at, c), 0.0) + g * g) - math.sqrt(n.get((at, c), 0.0))) / li.ALPHA
                    z[at, c] = z.get((at, c), 0.0) + g - step * w[at, c]
                    n[at, c] = n.get((at, c), 0.0) + g * g
    rows = [(*li.weighed(li.gram_counts(t), np.ones(li.BUCKETS)), y) for t, y in texts]
    got = li.fit(rows, 3)
    want = np.zeros_like(got)
    for at, c in z:
        want[at, c] = weight(at, c)
    assert np.allclose(got, want, atol=1e-5) and (want != 0).any()
