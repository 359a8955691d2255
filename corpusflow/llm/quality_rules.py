"""Quality rules with risk-controlled thresholds.

Each rule scores a text; a higher score is worse. The cutoff of a rule in a stratum, a language, is the strictest of a fixed grid for which an exact
binomial bound shows, from labelled texts that the grid was not made from, that good texts are rejected at a rate of at most the rule's share
of ``risk``. The rule's null hypothesis is "the rate is above its share"; its p-value is the binomial probability of at most as many rejected good
texts as were seen. The level is divided by the number of rules and strata (Bonferroni). Within a grid the numbers of rejected texts
grow as cutoffs get stricter, so testing from the loosest to the strictest and stopping at the first failure needs no further correction. By the union
bound, the rules together reject at most ``risk`` of the good texts of each stratum, with the stated confidence for all strata at once.

Defined results: a null text has no words and fails the base rules; a null language is a stratum of its own; a stratum with too few labels
for any cutoff rejects nothing beyond the base rules; a document with several labels counts as good if one says so; null labels count as
none; repeated rows each get a result; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.rows import with_once
from corpusflow.llm.common import let, words_of
from corpusflow.session import settle

WINDOW = 5
RISK = 0.05
LEVEL = 0.05
#: (name, grid of cutoffs from strict to loose); a text fails a rule if its score is above the cutoff.
GRIDS = (
    ("symbols", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.7, 1.0)),  # symbols per word
    ("dup_lines", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0)),  # repeated lines per 10 words
    ("repeats", (0.02, 0.04, 0.07, 0.1, 0.13, 0.16, 0.2)),  # share of words in repeated windows
    ("upper", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),  # A-Z per character of a word
    ("long_words", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),  # mean length of a word
)


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the counts that the rules use, each from one pass over the words of a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counts = {
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_words": words_of(F.col("text")),
    }
    once = with_once(docs.select(*keep, "text"), **counts)
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))
    ).otherwise(F.array().cast("array<long>"))
    once = with_once(
        once.drop("text"), n_words=n.cast("long"), word_chars=F.length(F.concat_ws("", "_words")).cast("long"),
        n_repeat_words=let(windows, _covered),
    )
    return once.drop("_words")


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash comes twice or more."""

    def repeated(pairs: Column) -> Column:
        def twin(e: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(pairs, j - 1)["h"] == e["h"]).otherwise(False)
            return before | F.coalesce(F.get(pairs, j + 1)["h"] == e["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(pairs, twin), lambda e: e["i"]))

    def reach(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
        let(pairs, lambda p: let(repeated(p), reach))
    )


def _scores() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / n,
        "dup_lines": 10 * F.col("n_dup_lines") / n,
        "repeats": F.col("n_repeat_words") / n,
        "upper": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "long_words": F.col("word_chars") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for a binomial X of n trials; 1 beyond the mean, where no test passes."""
    start = n * F.lit(math.log1p(-p))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(math.log(p / (1 - p)))
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    first = F.struct(start.alias("term"), F.exp(start).alias("sum"))
    more = F.aggregate(F.sequence(F.lit(1).cast("long"), k), first, step)["sum"]
    return F.when(k > n * p, F.lit(1.0)).when(k == 0, F.exp(start)).otherwise(more)


def thresholds(labelled: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, cut_<rule>...): the cutoffs from the features of labelled texts (stratum, good); null where no cutoff passes."""
    scores = _scores()
    good = labelled.filter("good = 1")
    counts = settle(good.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.array(*[F.count_if(scores[r] > F.lit(c)) for c in grid]).alias(f"k_{r}") for r, grid in GRIDS],
    ))
    tests = max(1, counts.count() * len(GRIDS))
    share = risk / len(GRIDS)

    def strictest(rule: str, grid: tuple[float, ...]) -> Column:
        cuts = F.array(*[F.lit(c) for c in grid])
        passed = F.filter(cuts, lambda c: tail(F.get(f"k_{rule}", (F.array_position(cuts, c) - 1).cast("int")), F.col("n"), share) <= level / tests)
        return F.array_min(passed).alias(f"cut_{rule}")

    return counts.select(F.col("stratum").alias("_stratum"), *[strictest(r, g) for r, g in GRIDS])


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed) of each row of ``docs``.

    ``labels`` has (doc_id, good): 1 for texts that should stay.
    """
    marked = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"), "text")
    found = settle(features(marked, ["doc_id", "stratum"]))
    known = labels.filter("good is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("good").alias("good"))
    labelled = found.filter(~base_failed()).join(known, F.col("doc_id") == F.col("_id"))
    cuts = settle(thresholds(labelled, risk, level))
    scores = _scores()
    fails = F.filter(F.array(*[F.when(scores[r] > F.col(f"cut_{r}"), F.lit(r)) for r, _ in GRIDS]), lambda x: x.isNotNull())
    out = found.join(cuts, F.col("stratum") == F.col("_stratum"), "left").withColumn("failed", fails)
    kept = ~base_failed() & (F.size("failed") == 0)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        kept.alias("kept"), "failed",
    )
