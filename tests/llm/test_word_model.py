import math
import random
from collections import Counter, defaultdict

import pytest

from corpusflow.llm import quality_model as qm
from corpusflow.llm import word_model as wm
from tests.llm.cases import documents, prose


def plain_cost(texts, spell):
    """Interpolated modified Kneser-Ney over word trigrams, straight from its definition."""
    counts = [Counter() for _ in range(4)]
    for text in texts:
        row = ["<", "<", *wm.words(text), ">"]
        counts[3].update(zip(row, row[1:], row[2:], strict=False))
    for k in (2, 1):
        counts[k].update(gram[1:] for gram in counts[k + 1])
    cuts, totals, rest = {}, {}, {}
    for k in (1, 2, 3):
        of = Counter(counts[k].values())
        cuts[k] = qm._discounts_of(*[of[i] for i in (1, 2, 3, 4)])
        totals[k], rest[k] = Counter(), defaultdict(float)
        for gram, n in counts[k].items():
            totals[k][gram[:-1]] += n
            rest[k][gram[:-1]] += cuts[k][min(n, 3) - 1]

    def p(gram):
        k = len(gram)
        if not k:
            return None
        lower = p(gram[1:]) if k > 1 else math.exp(-(spell(" ") if gram[0] == ">" else spell(gram[0] + " ")))
        total = totals[k][gram[:-1]]
        if not total:
            return lower
        n = counts[k][gram]
        return ((n - cuts[k][min(n, 3) - 1] if n else 0) + rest[k][gram[:-1]] * lower) / total

    def cost(text):
        row = ["<", "<", *wm.words(text), ">"]
        return -sum(math.log(p(g)) for g in zip(row, row[1:], row[2:], strict=False))

    return cost


@pytest.mark.parametrize(("run", "frequent", "sample"), [(500, 10, 1000), (500, 300, 1000), (20, 300, 0)])
def test_costs_are_those_of_the_definition(spark, monkeypatch, run, frequent, sample):
    monkeypatch.setattr(wm, "RUN", run)
    monkeypatch.setattr(wm, "FREQUENT", frequent)
    monkeypatch.setattr(wm, "SAMPLE", sample)
    monkeypatch.setattr(wm, "LEAST_SHARDS", 5)
    rows = [(i, prose(i % 90, 25, "eta") + ("  \n漢字の文。" if i % 3 else ", x y x y x"), "en", None) for i in range(120)] + [(500, "", "en", None), (501, None, "en", None)]
    rows += [rows[7], rows[7], rows[110]]  # copies get the cost of one, and count in training
    spell = lambda text: 1.5 * len(text.encode())
    coder = lambda: wm.Coder(spell)
    from pyspark.sql import functions as F

    docs = documents(spark, rows).select(
        "doc_id", "text", wm.half(F.col("doc_id")).alias("half"), (F.col("doc_id") < 100).alias("trusted"), F.col("doc_id").alias("who"), F.lit(1).cast("long").alias("more")
    )
    halves = {r["doc_id"]: r["half"] for r in docs.collect()}
    plain = [plain_cost([t for i, t, _, _ in rows if i < 100 and halves[i] == h], spell) for h in (0, 1)]
    got = {r["who"]: r for r in wm.scored(docs, coder, qm._discounts_of).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, text, _, _ in rows:
        assert got[i]["nll"] == pytest.approx(plain[1 - halves[i]](text) if text else 0, rel=1e-9)


def test_frequent_words_fill_shards_evenly():
    """The memory of a task is that of its fullest shard."""
    sizes = [n for n in (90_000, 60_000) for _ in range(2)] + [40_000 // i for i in range(1, 2000)]
    shards, parts = 10, [3, 3, 1, 1] + [1] * 1999
    filled = [0.0] * shards
    for n, k, at in zip(sizes, parts, wm._placed(sizes, parts, shards), strict=True):
        for j in range(k):
            filled[(at + j) % shards] += n / k
    assert max(filled) <= 1.05 * sum(sizes) / shards


def test_equal_trigrams_are_counted_once():
    import numpy as np

    rnd = random.Random(5)
    rows = [tuple(rnd.randrange(3) for _ in range(4)) for _ in range(500)]
    one, times = wm._distinct(*(np.array(v, np.int32) for v in zip(*rows, strict=True)))
    assert list(one) == sorted(one) and {rows[i]: times[i] for i in one} == Counter(rows) and len(one) == len(set(rows))


def test_words_in_wrong_order_are_rejected(spark):
    rnd = random.Random(3)
    # all words begin and end alike, so that letters at their borders do not tell the order
    phrases = [" ".join(f"ab{prose(8 * i + j, 1, 'etoinshr')}ba" for j in range(8)) for i in range(40)]
    texts = [" ".join(rnd.choice(phrases) for _ in range(12)) for _ in range(300)]
    salad = [" ".join(rnd.sample(t.split(), len(t.split()))) for t in texts[:20]]
    han = ["".join(rnd.choice(["天地玄黄", "宇宙洪荒", "日月盈昃", "辰宿列张"]) for _ in range(30)) for _ in range(300)]
    mixed = ["".join(rnd.sample(t, len(t))) for t in han[:20]]
    rows = [(i, t, "en", None) for i, t in enumerate(texts)] + [(1000 + i, t, "zh", None) for i, t in enumerate(han)]
    bad = [(5000 + i, t, "en", None) for i, t in enumerate(salad)] + [(6000 + i, t, "zh", None) for i, t in enumerate(mixed)]
    labels = spark.createDataFrame([(r[0], 1) for r in rows if r[0] % 2], "doc_id long, good int")
    kept = {r["doc_id"] for r in qm.good_documents(documents(spark, rows + bad), labels).collect()}
    assert not kept & {r[0] for r in bad} and len(kept) >= 0.97 * len(rows)


def test_a_shard_takes_little_memory_for_each_trigram():
    """The peak of a task's memory while it numbers the trigrams of a shard; gathering all columns twice took 151 bytes of each."""
    import tracemalloc

    import numpy as np

    known = wm.Frequent([(f"w{i}", 8 * i + 4, 1.0) for i in range(1000)], 1.0, [1] * 1002, [0] * 1002)
    rnd, n, blobs = np.random.default_rng(3), 0, []
    for _ in range(8):
        words = [rnd.integers(2, 1002, 40_000).astype(np.uint16) for _ in range(3)]
        blobs.append(wm._packed(np.zeros(40_000, np.int32), np.full(40_000, 2, np.uint8), np.ones(40_000, np.int32), *words, np.empty(0, np.uint64), np.empty(0, np.float32)))
        n += 40_000
    tracemalloc.start()
    shard = wm._Shard(blobs, known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(shard.doc) == n and peak < 140 * n


def test_facts_travel_packed(spark, monkeypatch):
    """Shards tell a few rows to be summed and one packed row for each part, not a row for each word, pair and context."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(wm, "SAMPLE", 0)  # no word is frequent, so every word is asked for
    monkeypatch.setattr(wm, "LEAST_SHARDS", 4)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "en", None) for i in range(50)]
    docs = documents(spark, rows).select(F.col("doc_id").alias("who"), F.lit(1).cast("long").alias("more"), F.lit(2).alias("kind"), "text")
    coder = lambda: wm.Coder(lambda text: 1.0)
    known = spark.sparkContext.broadcast(wm.frequent(docs, coder, 4))
    runs = wm.encoded_runs(docs, known, coder)
    told = sum(wm.facts(wm.sent(runs.table, known, 4, now, True), known, 4).count() for now in range(wm.PASSES))
    assert told <= 4 * (4 + 1 + 4 + 4) < 50 * 40
