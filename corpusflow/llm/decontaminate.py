"""Benchmark decontamination by pigeonhole edit matching.

A test item that may differ in k characters is cut into k + 1 pieces: an occurrence with at most k edits has at least one piece unchanged. One
Aho-Corasick automaton finds all pieces of all items in a text; around each hit Myers' bit-parallel algorithm gives the least edit
distance of the item to any part of the text, and the document is contaminated if that is within the item's budget.

Texts and items are compared lower-cased, without ASCII punctuation, with each run of white space as one space. Items are looked for in blocks of
at most ``block_chars`` characters (or one item); each block is collected and broadcast on its own and all documents are read once for it.

An item of fewer than ``LEAST_CHARS`` characters after this may not differ at all and is found where it stands word for word, punctuation
included: letters and digits may not go on at its ends, but for scripts that are written without spaces.

Defined results: null and empty texts hold nothing; items that are null or shorter than ``least_chars`` in that form are not looked for, as they
would match anywhere; equal items all get the hit; repeated rows each get a result; an empty table of documents or items gives no hit. Only
doc_id and text, and item_id and text, are read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.llm import word_model
from corpusflow.llm.common import encoded, map_texts, packed, running_sums, texts_of, unpacked
from corpusflow.session import settle

ERROR_RATE = 0.05
LEAST_CHARS, FEWEST_CHARS = 20, 5
BLOCK_CHARS = 1 << 20
_PUNCTUATION = string.punctuation.encode()
_UNSPACED = re.compile(rf"[{word_model.ALONE}]")


def normal(text: str | None) -> str:
    return " ".join(encoded((text or "").lower()).translate(None, _PUNCTUATION).decode().split())


def verbatim(text: str | None) -> str:
    """The form in which short items are looked for."""
    return " ".join((text or "").lower().split())


def _goes_on(a: str, b: str) -> bool:
    """Whether a word goes on from one character to the next."""
    return a.isalnum() and b.isalnum() and not (_UNSPACED.match(a) or _UNSPACED.match(b))


def pieces(item: str, error_rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, str]]]:
    """Error budget of an item, and its pieces with their places."""
    budget = int(len(item) * error_rate)
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """For each character, the bits of its places in the item."""
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def least_distance(peq: dict[str, int], m: int, text: str) -> int:
    """Least edit distance of an item of m characters to any part of ``text``, column by column in bit vectors."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    break
        ph = (ph << 1) & full
        pv = ((mh << 1) | ~(xv | ph)) & full
        mv = ph & xv
    return best


class Matcher:
    """All items of a block: (ids, text, budget, masks) and the automaton over their pieces; short items have an automaton of their own."""

    def __init__(self, rows: list[tuple], error_rate: float) -> None:
        by_text: dict[str, list] = {}
        by_words: dict[str, list] = {}
        for item_id, text, words in rows:
            if len(text) >= LEAST_CHARS:
                by_text.setdefault(text, []).append(item_id)
            else:
                by_words.setdefault(words, []).append(item_id)
        self.items, places = [], {}
        for text, ids in by_text.items():
            budget, parts = pieces(text, error_rate)
            for at, piece in parts:
                places.setdefault(piece, []).append((len(self.items), at))
            self.items.append((ids, text, budget, masks(text)))
        self.automaton, self.short = (ahocorasick.Automaton() for _ in range(2))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        for words, ids in by_words.items():
            self.short.add_word(words, (words, ids))
        self.any_short = bool(by_words)
        for made in (self.automaton, self.short):
            if len(made):
                made.make_automaton()

    def found(self, text: str | None) -> Iterator[tuple[object, int]]:
        """(item id, least distance) of the items that a text holds."""
        yield from self.hits(normal(text))
        if self.any_short and text:
            seen: set[str] = set()
            line = f" {verbatim(text)} "
            for end, (words, ids) in self.short.iter(line):
                begin = end + 1 - len(words)
                if words not in seen and not _goes_on(line[begin - 1], words[0]) and not _goes_on(words[-1], line[end + 1]):
                    seen.add(words)
                    yield from ((i, 0) for i in ids)

    def hits(self, text: str) -> Iterator[tuple[object, int]]:
        """(item id, least distance) of the items that the normal form of a text holds."""
        if not self.items or not text:
            return
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for item, at in where:
                starts.setdefault(item, set()).add(end + 1 - length - at)
        for item, begins in starts.items():
            ids, pattern, budget, peq = self.items[item]
            best, m = budget + 1, len(pattern)
            ordered = sorted(begins)
            while ordered and best:
                upto = 1
                while upto < len(ordered) and ordered[upto] - ordered[upto - 1] <= 2 * budget + m:
                    upto += 1
                window = text[max(0, ordered[0] - budget) : ordered[upto - 1] + m + budget]
                best = min(best, 0 if pattern in window else least_distance(peq, m, window))
                del ordered[:upto]
            if best <= budget:
                for item_id in ids:
                    yield item_id, best


def find_items(
    docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, least_chars: int = FEWEST_CHARS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, text_hash, item_id, distance) of each item found in a text; rows of the same doc_id and text come once."""
    spark = docs.sparkSession
    wanted = map_texts(items, ["item_id"], "text", lambda t: (normal(t), verbatim(t)), {"normal": "string", "words": "string"})
    wanted = settle(wanted.withColumnRenamed("normal", "text").filter(F.length("words") >= least_chars))
    placed = settle(running_sums(wanted, [], ["words", "item_id"], {"before": F.length("words")}).withColumn(
        "block", F.floor(F.col("before") / F.lit(block_chars))
    ))
    id_kind, item_kind = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = f"doc_id {id_kind.simpleString()}, text_hash long, item_id {item_kind.simpleString()}, distance int"
    item_arrow = to_arrow_type(item_kind)
    found = []
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    for (block,) in placed.select("block").distinct().orderBy("block").collect():  # a few numbers
        rows = [tuple(r) for r in placed.filter(F.col("block") == block).select("item_id", "text", "words").collect()]
        sent = spark.sparkContext.broadcast(rows)  # at most block_chars characters, or one item

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, error_rate)
            for batch in batches:
                hits = [
                    (i, item_id, distance)
                    for i, text in enumerate(texts_of(batch.column("text")))
                    for item_id, distance in matcher.found(text)
                ]
                at = pa.array([h[0] for h in hits], type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("text_hash").take(at),
                        pa.array([h[1] for h in hits], type=item_arrow), pa.array([h[2] for h in hits], type=pa.int32()),
                    ],
                    ["doc_id", "text_hash", "item_id", "distance"],
                )

        found.append(texts.mapInArrow(search, schema))
    if not found:
        return spark.createDataFrame([], schema)
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return hits.distinct()


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, distance) of each row of ``docs``; the least distance is null without a hit."""
    hits = settle(find_items(docs, items, **settings))
    by_doc = hits.groupBy(F.col("doc_id").alias("_doc_id"), "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("distance")
    )
    keys = docs.select("doc_id", F.xxhash64("text").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_hash") == F.col("text_hash"))
    n = F.when(F.col("text_hash").isNull(), 0).otherwise(F.size("item_ids")).cast("long")
    return keys.join(by_doc, same, "left").select(
        "doc_id", F.col("text_hash").isNotNull().alias("contaminated"), n.alias("n_items"),
        F.coalesce("item_ids", F.array().cast(by_doc.schema["item_ids"].dataType)).alias("item_ids"), "distance",
    )


def clean_documents(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    hits = settle(find_items(docs, items, **settings)).select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = packed(docs, id=F.col("doc_id"), hash=F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("_doc_id")) & (F.col("hash") == F.col("_hash"))
    return rows.join(hits, same, "left_anti").select(*unpacked(docs.columns))
