"""Rows that every operator must handle, and brute-force versions to compare with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves; documents may have columns of these names as well.
CLASHING = (
    "size n target copies taken before part _part rank weight place tie fp rep root node a b u v m unit point band leaf shingles "
    "stratum threshold _threshold _stratum kept failed good n_words _words words g p c w nll _nll text_hash _hash _doc_id _gone item_id "
    "distance spans n_tokens score lang_pred held_out template purity host path rule verdict _chance _share _near_row block label"
).split()


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents of (doc_id, text, lang, source), with clashing extra columns."""
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return frame.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHING])


def odd_rows() -> list[tuple]:
    rnd = random.Random(5)
    long = " ".join(rnd.choice(["the", "and", "of", "there", "in"]) + str(rnd.randint(0, 9)) for _ in range(30_000))
    same = (7, "this row is here twice with the very same words in it, word for word", "en", "s1")
    return [
        (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\n\x0b\x0c\r ", None, None), (4, long, "en", None), (5, "x" * 50_000, "en", "s2"),
        same, same, (8, same[1], "en", "s2"), (None, "a row without an id but with words", "de", "s2"), (None, None, None, None),
        (9, "é ü ß 漢字 😀 — “quotes”\u00a0and\u2028lines", "fr", ""), (10, "word", "en", "s3"), (7, "another text under a number that is taken", "en", "s1"),
        (11, "12 34 !!! ***", "en", "s3"), (12, None, None, "s4"),
    ]


def prose(seed: int, words: int, letters: str = "etaoinshr") -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))) for _ in range(words))
