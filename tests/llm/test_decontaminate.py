import random

from corpusflow.llm import decontaminate
from tests.llm.cases import documents, odd_rows, prose

ITEMS = "item_id long, text string"


def distance_inside(item, text):
    """Least edit distance of the item to any part of the text."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def edited(text, edits, rnd):
    chars = list(text)
    for _ in range(edits):
        at = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        if kind == 0:
            chars[at] = "z"
        elif kind == 1:
            chars.insert(at, "q")
        else:
            del chars[at]
    return "".join(chars)


def test_against_brute_force(spark):
    rnd = random.Random(2)
    items = [(i, prose(i, 12 + i * 3)) for i in range(8)] + [(100, prose(3, 21)), (101, "short"), (102, None), (103, "")]
    rows = []
    for d in range(60):
        item = items[d % 8][1]
        part = edited(item, rnd.randint(0, 1 + len(item) // 14), rnd)
        rows.append((d, f"{prose(100 + d, d % 5 * 8)} {part.upper()},\n\n {prose(200 + d, 9)}", None, None))
    wanted = {
        (d, i, k)
        for d, text, _, _ in rows
        for i, item in items
        if item and len(n := decontaminate.normal(item)) >= 20 and (k := distance_inside(n, decontaminate.normal(text))) <= int(len(n) * 0.05)
    }
    assert 10 < len(wanted) < 60 * 8 and len({k for _, _, k in wanted}) > 2
    for chars in (decontaminate.BLOCK_CHARS, 100):  # one block, many blocks
        hits = decontaminate.find_items(documents(spark, rows), spark.createDataFrame(items, ITEMS), block_chars=chars)
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in hits.collect()} == wanted


def test_odd_rows_and_columns(spark):
    item = prose(1, 30)
    rows = [*odd_rows(), (20, f"before {item} after", "en", "s"), (20, f"before {item} after", "en", "s"), (20, "clean under the same number", "en", "s"), (None, item, None, None)]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(5, item), (6, item), (7, None)], ITEMS).selectExpr("*", "1 as doc_id", "2 as distance")
    found = decontaminate.contamination(docs, items).collect()
    assert len(found) == len(rows)
    assert sorted((str(r["doc_id"]), r["item_ids"], r["n_items"]) for r in found if r["contaminated"]) == [("20", [5, 6], 2)] * 2 + [("None", [5, 6], 2)]
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "What is 2+2? Four!"), (2, "你好吗今天天气怎么样"), (3, "a+b=c"), (4, "cat"), (5, "x  Y z?")]
    rows = [
        (1, "so what  is\n2+2? four! yes", None, None), (2, "what is 22 four", None, None), (3, "他说你好吗今天天气怎么样呢", None, None), (4, "abc a+b=cd xa+b=c", None, None),
        (5, "(A+B=C)", None, None), (6, "the cat", None, None), (7, "x y z? z", None, None), (8, "ax y z?", None, None), (9, "", None, None), (10, None, None, None),
    ]
    found = decontaminate.find_items(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(1, 1, 0), (3, 2, 0), (5, 3, 0), (7, 5, 0)]


def test_no_rows(spark):
    docs, none = documents(spark, [(1, "a text of some words", None, None)]), spark.createDataFrame([], ITEMS)
    assert [tuple(r) for r in decontaminate.contamination(docs, none).collect()] == [(1, False, 0, [], None)]
    assert decontaminate.contamination(documents(spark, []), spark.createDataFrame([(1, prose(1, 30))], ITEMS)).count() == 0
