"""Ranked lexical search with range-maximum tables over posting lists.

Documents are read once for the terms of the items: each becomes a row of its length, the numbers of the terms that it shares with any item, and how
often it has them. Numbers of documents that hold a term are sums over these rows. Each task then takes its rows in parts of at most
``POSTINGS`` postings and indexes a part: the posting list of a term is the impacts of its documents in the order of the part, with a sparse table that
gives the place of the largest impact of any range in constant time.

For an item, intervals of the part's documents wait by their bound, the sum over the terms of weight times the largest impact in the interval. The best
ones are taken first. Of each, the document with the largest single contribution is scored exactly and splits the interval into what lies before and after
it, each with a bound of its own. An interval whose bound is below the score of the last document of the current list of ``k`` is dropped: nothing
in it can be listed, so the result is exact. The list goes on from part to part of a task, and the lists of all tasks are merged.

Documents with equal rows, such as copies, are one entry of a part with their ids in order, so many equal scores cannot hold an interval open.

Items are numbered and taken in blocks of at most ``BLOCK_CHARS`` characters (or one item), which alone are collected and sent to the tasks; all documents
are read once for each block.

Defined results: null texts have no term; an item without a term, or without a document that shares one, gets no row; documents without an id come after
those with one at equal scores; repeated rows of documents or items are documents and items of their own; equal rows of documents may take several ranks; empty
tables give an empty table. Only doc_id and text, and item_id and text, are read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.llm.common import encoded, running_sums, texts_of
from corpusflow.session import settle

TOP = 20
POSTINGS = 1 << 21
BLOCK_CHARS = 1 << 22
_SLICE = 1 << 20
_WIDEST = 512  # intervals taken in one step
_SALTS = 64


def _classes() -> bytes:
    """Letters and digits of ASCII, lower-cased, and all bytes of other characters; everything else is a space."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for first, last, to in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
        for i in range(ord(last) - ord(first) + 1):
            out[ord(first) + i] = ord(to) + i
    return bytes(out)


_TABLE = _classes()


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of a bounded part of it."""
    data = encoded(text).translate(_TABLE)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + _SLICE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


class Part:
    """Posting lists of some documents with their range-maximum tables."""

    def __init__(self, ids: list[list], lengths: np.ndarray, starts: np.ndarray, term: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int) -> None:
        """``ids``: of each entry, in order; ``term`` and ``times`` hold the postings of all entries, which begin at ``starts``."""
        self.ids = ids
        entry = np.repeat(np.arange(len(ids)), np.diff(starts, append=len(term)))
        m = 100 - 25 + (25 * lengths.astype(np.int64) * n_docs) // n_terms
        order = np.argsort(term, kind="stable")
        self.doc = entry[order].astype(np.int64)
        times = times[order].astype(np.int64)
        self.impact = (10**9 * times) // (1000 * times + 12 * m[self.doc])
        self.terms, begin = np.unique(term[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.key = np.repeat(np.arange(len(self.terms)), np.diff(self.begin)) * len(ids) + self.doc
        self.table = [np.arange(len(order), dtype=np.int32)]
        longest = int(np.diff(self.begin).max(initial=1))
        for k in range(1, longest.bit_length()):
            half, below = 1 << k - 1, self.table[-1]
            a, b = below[:-half], below[half:]
            self.table.append(np.where(self.impact[a] >= self.impact[b], a, b))
        self.level = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.table)):
            self.level[1 << k :] = k
        # all levels one after the other, so that one look-up serves ranges of different lengths
        self.flat = np.concatenate(self.table)
        self.at = np.cumsum([0, *(len(t) for t in self.table)])[:-1]
        self.table = None

    def best(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the largest impact in each range of postings; an empty range has the value 0."""
        size = high - low
        empty = size <= 0
        k = self.level[np.maximum(size, 1)]
        left = self.at[k] + np.where(empty, 0, low)
        right = self.at[k] + np.where(empty, 0, high - (1 << k))
        a, b = self.flat[left], self.flat[right]
        va, vb = self.impact[a], self.impact[b]
        return np.where(va >= vb, a, b), np.where(empty, 0, np.maximum(va, vb))

    def search(self, wanted: dict[int, int], found: list[tuple], k: int) -> int:
        """Put the documents that belong to the ``k`` best for weights by term into the heap ``found``; the number of documents scored."""
        asked, weight = np.array([t for t, w in wanted.items() if w > 0], np.int64), np.array([w for w in wanted.values() if w > 0], np.int64)
        lists = np.searchsorted(self.terms, asked)
        there = self.terms[np.minimum(lists, len(self.terms) - 1)] == asked
        lists, weight = lists[there], weight[there]
        if not len(lists):
            return 0
        low, high = self.begin[lists][None, :], self.begin[lists + 1][None, :]
        place, value = self.best(low, high)
        bound, scored, width = (value * weight).sum(axis=1), 0, 8
        while len(bound):
            least = found[0][0] if len(found) >= k else 1
            take = bound >= least
            if not take.all():
                low, high, place, value, bound = (x[take] for x in (low, high, place, value, bound))
                if not len(bound):
                    break
            if len(bound) > width:
                first = np.argpartition(bound, len(bound) - width)[::-1]
                now, later = first[:width], first[width:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            lo, hi, at, val = low[now], high[now], place[now], value[now]
            split = self.doc[at[np.arange(len(now)), (val * weight).argmax(axis=1)]]
            pos = np.searchsorted(self.key, lists * len(self.ids) + split[:, None])
            inside = (pos < hi) & (self.doc[np.minimum(pos, len(self.doc) - 1)] == split[:, None])
            score = (np.where(inside, self.impact[np.minimum(pos, len(self.doc) - 1)], 0) * weight).sum(axis=1)
            scored += len(now)
            for i in np.flatnonzero(score >= least):
                self._list(int(score[i]), self.ids[split[i]], found, k)
            new_low, new_high = np.concatenate([lo, pos + inside]), np.concatenate([pos, hi])
            new_place, new_value = self.best(new_low, new_high)
            low, high, place, value = (
                np.concatenate([x[later], y]) for x, y in ((low, new_low), (high, new_high), (place, new_place), (value, new_value))
            )
            bound = np.concatenate([bound[later], (new_value * weight).sum(axis=1)])
            width = min(_WIDEST, 2 * width)
        return scored

    @staticmethod
    def _list(score: int, ids: list, found: list[tuple], k: int) -> None:
        for doc_id in ids[:k]:  # in order, so the rest has no chance when one has none
            entry = (score, *_later_first(doc_id), doc_id)
            if len(found) < k:
                heapq.heappush(found, entry)
            elif entry[:3] > found[0][:3]:
                heapq.heapreplace(found, entry)
            else:
                return


def _later_first(doc_id: int | None) -> tuple[int, int]:
    """Order of ids within a score, in which the ids that are listed first are the largest."""
    return (0, 0) if doc_id is None else (1, -doc_id)


def _blocks(items: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """(block, item, item_id, text) of items with a text, numbered, and the number of blocks."""
    held = items.select("item_id", "text").filter("text is not null and text <> ''")
    held = held.withColumn("chars", F.length("text").cast("long"))
    ordered = running_sums(held, [], ["item_id", "text"], {"before": F.col("chars"), "item": F.lit(1).cast("long")})
    ordered = settle(ordered.select(F.floor(F.col("before") / block_chars).alias("block"), "item", "item_id", "text"))
    return ordered, (ordered.agg(F.max("block")).first()[0] or 0) + 1


def shared_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times): length of each document, and the numbers of the terms it shares with the vocabulary, in order."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "terms", "times"]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            lengths, own, times = [], [], []
            for text in texts_of(batch.column("text")):
                n, counts = 0, Counter()
                for part in terms(text):
                    n += len(part)
                    counts.update(filter(None, map(known.get, part)))
                lengths.append(n)
                own.append(sorted(counts))
                times.append([counts[t] for t in own[-1]])
            lists = [pa.array(own, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], names)
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(mapped, f"doc_id {id_type}, n long, terms array<int>, times array<int>")


def _searched(rows: DataFrame, wanted: list[tuple[int, dict[int, int]]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` documents of each task's rows for each item (number, weight by term)."""
    sent = rows.sparkSession.sparkContext.broadcast(wanted)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ids_type = to_arrow_type(rows.schema["doc_id"].dataType)

    def part(held: list[pa.RecordBatch]) -> Part | None:
        """Documents with equal rows become one entry; entries are in the order of their lengths."""
        ids: dict[tuple, list] = {}
        for batch in held:
            own, times = batch.column("terms"), batch.column("times")
            edges, flat = own.offsets.to_numpy(), own.values.to_numpy()
            often = times.values.to_numpy()
            for i, (doc_id, n) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                x, y = edges[i], edges[i + 1]
                if x < y:
                    ids.setdefault((n, flat[x:y].tobytes(), often[x:y].tobytes()), []).append(doc_id)
        if not ids:
            return None
        entries = sorted(ids)
        for e in entries:
            ids[e].sort(key=lambda d: (d is None, d or 0))
        starts = np.cumsum([0, *(len(e[1]) // 4 for e in entries)])[:-1]
        term, often = (np.frombuffer(b"".join(e[j] for e in entries), np.int32) for j in (1, 2))
        return Part([ids[e][:k] for e in entries], np.array([e[0] for e in entries]), starts, term, often, n_docs, n_terms)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        found: list[list[tuple]] = [[] for _ in items]

        def look(held: list[pa.RecordBatch]) -> None:
            if index := part(held):
                for (_, weights), best in zip(items, found, strict=True):
                    index.search(weights, best, k)

        held, size = [], 0
        for batch in batches:
            for begin in range(0, len(batch), 1024):
                held.append(batch.slice(begin, 1024))
                edges = held[-1].column("terms").offsets
                size += edges[-1].as_py() - edges[0].as_py()
                if size >= POSTINGS:
                    look(held)
                    held, size = [], 0
        look(held)
        rows = [(number, e[3], e[0]) for (number, _), best in zip(items, found, strict=True) for e in best]
        made = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], ids_type), pa.array([r[2] for r in rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(made, ["item", "doc_id", "score"])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(mapped, f"item long, doc_id {id_type}, score long")


def _listed(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each item with their ranks; lists are cut in salted groups first, so that no group grows with the number of tasks."""
    by = [F.desc("score"), F.col("doc_id").isNull(), F.col("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_SALTS)))
    near = salted.withColumn("at", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*by))).filter(F.col("at") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    named, n_blocks = _blocks(items, block_chars)
    out = None
    for block in range(n_blocks):
        texts = named.filter(F.col("block") == block).select("item", "text").orderBy("item").collect()
        counted = [(r["item"], Counter(t for part in terms(r["text"]) for t in part)) for r in texts]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}), 1)}
        rows = settle(shared_terms(docs, vocabulary))
        n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = rows.filter(F.size("terms") > 0).select(F.explode("terms").alias("term")).groupBy("term").count()
        df = {r["term"]: r["count"] for r in held.collect()}  # one row for each term of the block's items
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
        wanted = [(i, {vocabulary[t]: n * weight[vocabulary[t]] for t, n in c.items() if vocabulary[t] in weight}) for i, c in counted]
        found = _searched(rows.filter(F.size("terms") > 0), wanted, n_docs, max(n_terms, 1), k)
        out = found if out is None else out.union(found)
    listed = _listed(settle(out), k)
    names = named.select(F.col("item").alias("_item"), "item_id")
    return listed.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score")
