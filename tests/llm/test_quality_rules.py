import math
import random
import re

from corpusflow.llm import quality_rules as qr
from tests.llm.cases import documents, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def rows_to_count():
    rnd = random.Random(3)
    rows = [(100 + i, "\n".join(" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 12))), "en", None) for i in range(80)]
    return rows + [(300, "a b c d e " * 2000, "en", None), (301, "x\r\nx\nx \n\n#*$%&|<> é😀", "fr", None), *odd_rows()]


def test_counts_against_plain_python(spark):
    rows = rows_to_count()
    found = qr.judge(documents(spark, rows), spark.createDataFrame([], "doc_id long, good int")).collect()
    key = lambda r: (r[0] is None, r[0], r[1:])
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found), key=key)
    assert got == sorted(((i, *counts(t)) for i, t, _, _ in rows), key=key)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and r["kept"] == (not r["base_failed"])


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_cutoffs_against_exact_sums(spark):
    """Good texts of one language hold few symbols, of another many, and a third has too few labels."""
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(2400):
        lang = ["en", "de", "fr"][0 if i < 1200 else 1 if i < 2350 else 2]
        junk = i % 6 == 0
        words = prose(i, 20, "abcdefgh").split()
        for k in range(12 if junk else rnd.choice([0, 0, 0, 1]) if lang == "en" else rnd.choice([0, 5])):
            words[k] += "#"
        rows.append((i, " ".join(words), lang, None))
        labels.append((i, int(not junk)))
    found = {r["doc_id"]: r for r in qr.judge(documents(spark, rows), spark.createDataFrame([*labels, (0, 0), (1, None)], "doc_id long, good int")).collect()}
    share, grid = qr.RISK / len(qr.GRIDS), dict(qr.GRIDS)["symbols"]
    for lang in ("en", "de", "fr"):
        good = [r for r in rows if r[2] == lang and labels[r[0]][1]]
        shares = [r[1].count("#") / 20 for r in good]
        passing = [c for c in grid if tail(sum(s > c for s in shares), len(shares), share) <= qr.LEVEL / (3 * len(qr.GRIDS))]
        cut = min(passing, default=None)
        assert (cut is None) == (lang == "fr")
        for r in rows:
            if r[2] == lang:
                assert ("symbols" in found[r[0]]["failed"]) == (cut is not None and r[1].count("#") / 20 > cut)
                assert found[r[0]]["kept"] == (not found[r[0]]["failed"])
        assert sum(not found[r[0]]["kept"] for r in good) <= qr.RISK * len(good)
    assert not any(found[r[0]]["kept"] for r in rows if r[2] == "en" and r[0] % 6 == 0)


def test_no_rows_and_no_python(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, good int")
    assert qr.judge(documents(spark, []), labels).count() == 0
    plan = qr.features(documents(spark, odd_rows()), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
