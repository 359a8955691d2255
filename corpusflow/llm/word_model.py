"""Interpolated modified Kneser-Ney model of word trigrams, joined in shards with the trigrams of the documents.

Words are runs of letters, digits and marks; a character of a script written without spaces, a sign and a run of spaces beside the single ones are
words of their own, and so is the end of a text. Below the unigrams lies the spelling of a word by the symbol model of ``quality_model``, so words never seen
have a probability as well. All n-grams of the trusted text count; none is pruned.

Trigrams ``a b c`` are dealt to shards by their middle word. So a shard holds by itself the counts of its trigrams, those of the contexts ``a b`` and ``b``, and how many
words precede ``b c``; no table of n-grams is ever written. Only these sums over shards remain, the *facts*: how many words precede ``c``, and, for middle words so frequent that they fill a good part of a
shard and are cut by (a, c) into several, the pairs and contexts of that word. Each shard asks for the facts it needs and gets those. Documents go by in two phases:

1. Trusted trigrams are shuffled to the shards, which give counts of counts and facts. Other documents send only trigrams that ask for a fact.
2. All trigrams go to the shards; a shard counts the trusted ones, gives every trigram its cost, and sends each run of documents the sums.

Both go through the shards in ``PASSES`` parts, one after the other. Before, texts are split once and written as numbers of words, by runs of ``RUN`` words; hashes and spelling costs of the
words of a run that are not frequent stand beside them. Trigrams travel packed by runs: of the most frequent words (a sample of ``SAMPLE`` documents chooses them and the shards where they
are middle words, which changes no result) two bytes, of all others 64-bit hashes, column by column and compressed. Costs are summed in whole steps of 2 ** -30, in any order alike. Equal rows, told by a 128-bit hash of their contents, get equal costs.

A text would be known by heart to a model trained on it. Ids are therefore dealt to two halves, each with its model; a document is judged by
that of the other half, whether it is trusted or not.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from heapq import heapify, heapreplace
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import Brief, brief, map_parts, texts_of, thrifty
from corpusflow.session import settle

RUN = 1 << 18
SHARD = 1 << 20  # words, at about CHARS characters each
CHARS = 4
LEAST_SHARDS = 12
PASSES = 4
#: Trigrams whose costs are computed at once, so that what is held in between stays small.
SLICE = 1 << 17
#: Bytes of encoded texts that one task reads.
ENCODED = 16 << 20
#: Bytes of a batch that is handed to Python: blobs and texts are large, and buffers outside the heap hold whole batches.
BATCH = 2 << 20
#: Words sent as numbers of two bytes, chosen in a sample of about so many documents.
FREQUENT, SAMPLE = (1 << 16) - 1, 10_000
_STEPS = 1 << 30
ALONE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{ALONE}]|[^\W{ALONE}]+|\s{{2,}}|[^\w ]")
_AFTER = "\n\n\0"  # no word; stands for the place after a text
_START, _END = 1, 2  # hashes that stand for the places before and after a text
_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


#: What a row of facts tells: counts of counts of trigrams, of pairs and of words, words before a frequent word, pairs of a hot middle word, and packed facts.
_THIRD, _SECOND, _FIRST, _NUMBERED, _MIDDLE, _ASKED = range(6)
_X = [f"x{i}" for i in range(8)]
#: Packed facts of a shard: frequent words (number, words before in both halves), others by hash, hot pairs (hash of the last word, hot word) and hot contexts (hash of the first word, hot word).
_TOLD = (np.uint16, np.int32, np.int32, np.uint64, np.int32, np.int32, np.uint64, np.int32, np.int32, np.int32, np.uint64, np.int32, *[np.int32] * 8)


def half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(2)).cast("int")


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def keys(model: np.ndarray | int, *grams: np.ndarray) -> np.ndarray:
    """The key of n-grams of word hashes in a model; it depends on the order too."""
    out = _mixed(np.atleast_1d(model).astype(np.uint64) * np.uint64(_KEYS[0]) + np.uint64(len(grams)))
    for g in grams:
        out = _mixed(out * np.uint64(_KEYS[1]) + _mixed(g + np.uint64(_KEYS[2])))
    return out


class Coder:
    """Hashes and spelling costs of words; ``spell`` gives the cost of the bytes of a text, ``several`` those of many. A space ends a spelling."""

    def __init__(self, spell: Callable[[str], float], several: Callable[[list[str]], np.ndarray] | None = None) -> None:
        self.spell, self.several = spell, several or (lambda texts: np.array([spell(t) for t in texts], np.float64))

    def hashed(self, word: str) -> int:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 42) | 4

    def costs(self, words: list[str]) -> np.ndarray:
        return self.several([word + " " for word in words]).astype(np.float32)


class Frequent:
    """The most frequent words by number: places before and after a text first, then others; ``parts`` says over how many shards one is cut, ``shard`` where it begins."""

    def __init__(self, found: list[tuple[str, int, float]], end: float, parts: list[int], shard: list[int]) -> None:
        self.number = {word: i for i, (word, _, _) in enumerate(found, 2)}
        self.hashes = np.array([_START, _END, *(h for _, h, _ in found)], np.uint64)
        self.base = np.array([0.0, end, *(b for _, _, b in found)])
        self.parts, self.shard = np.array(parts, np.int64), np.array(shard, np.int64)
        hot = np.flatnonzero(self.parts > 1)
        self.hot = np.sort(self.hashes[hot])


def frequent(docs: DataFrame, coder: Callable[[], Coder], shards: int) -> Frequent:
    """Chosen by a sample of texts (by hash); it decides how trigrams are packed and dealt, never what they cost."""

    def counted(texts: Iterator[str | None]) -> Iterator[dict]:
        counts: Counter = Counter()
        for text in texts:
            if text:
                counts[None] += 1
                found = _WORD.finditer(text)
                while some := [m.group() for m in islice(found, RUN)]:
                    counts.update(some)
                if len(counts) > 4 * RUN:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts.clear()
        if counts:
            yield {"word": list(counts), "n": list(counts.values())}

    rows = docs.count()
    some = docs.filter(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE / max(rows, 1))))
    counts = brief(map_parts(some, "text", counted, {"word": "string", "n": "long"}).groupBy("word").agg(F.sum("n").alias("n")))
    total, texts = counts.table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0))).first()

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder()
        for batch in batches:
            found = batch.column("word").to_pylist()
            hashes = np.array([0 if w is None else code.hashed(w) for w in found], np.uint64)
            base = code.costs([w or "" for w in found]).astype(np.float64)  # of the end: that of a space
            columns = [pa.array(hashes.view(np.int64)), pa.array(base)]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *columns], ["word", "n", "hash", "base"])

    top = counts.table.filter("word is not null").orderBy(F.desc("n"), "word").limit(FREQUENT - 2)
    top = top.union(docs.sparkSession.range(1).select(F.lit(None).cast("string"), F.lit(0).cast("long"))).coalesce(1)
    found = top.mapInArrow(spelled, "word string, n long, hash long, base double").collect()
    counts.delete()
    end = next(r["base"] for r in found if r["word"] is None)
    found = [r for r in found if r["word"] is not None]
    # a word that fills a shard or more is cut into parts of about half a shard
    sizes = [texts, texts, *(r["n"] for r in found)]
    parts = [min(shards, int(2 * shards * n / total)) if total and shards * n >= total else 1 for n in sizes]
    return Frequent([(r["word"], r["hash"] & (1 << 64) - 1, r["base"]) for r in found], end, parts, _placed(sizes, parts, shards))


def _placed(sizes: list[int], parts: list[int], shards: int) -> list[int]:
    """The first shard of each frequent word, so that shards get about equal sums of sizes: cut words one after the other, then the largest to the least filled."""
    filled, out, at = [0.0] * shards, [0] * len(sizes), 0
    for i, (n, k) in enumerate(zip(sizes, parts, strict=True)):
        if k > 1:
            out[i] = at
            for j in range(k):
                filled[(at + j) % shards] += n / k
            at = (at + k) % shards
    heap = [(n, i) for i, n in enumerate(filled)]
    heapify(heap)
    for i in sorted((i for i, k in enumerate(parts) if k == 1), key=lambda i: -sizes[i]):
        n, out[i] = heap[0]
        heapreplace(heap, (n + sizes[i], out[i]))
    return out


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, byte by byte of their values, compressed."""
    data = b"".join(np.ascontiguousarray(np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T).tobytes() for v in columns)
    sizes = np.array([len(data), *(len(v) for v in columns)], np.int64).tobytes()
    return sizes + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _unpacked(blob: bytes | pa.Buffer, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(kinds) + 1)
    data = np.frombuffer(pa.Codec("zstd").decompress(blob[sizes.nbytes :], int(sizes[0])), np.uint8)
    out, at = [], 0
    for n, kind in zip(sizes[1:], kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


_GRAMS = (np.int32, np.uint8, np.int32, np.uint16, np.uint16, np.uint16, np.uint64, np.float32)


class _Numbers(dict):
    """Numbers of the frequent words and of the places around a text; other words get the next numbers as they come."""

    def __init__(self, known: Frequent) -> None:
        super().__init__(known.number, **{"": 0, _AFTER: 1})
        self.first, self.rare = len(known.hashes), []

    def __missing__(self, word: str) -> int:
        number = self[word] = self.first + len(self.rare)
        self.rare.append(word)
        return number

    def forget(self) -> None:
        for word in self.rare:
            del self[word]
        self.rare = []


#: Documents (who, more, kind), slices of texts (words, document), words by number, and of the others hashes and spelling costs.
_RUN = (np.int64, np.int64, np.uint8, np.int32, np.int32, np.int32, np.uint64, np.float32)


class _Run:
    """Words of some documents, up to ``RUN`` and a text's last slice, as numbers."""

    def __init__(self, known: Frequent, code: Coder) -> None:
        self.code, self.number = code, _Numbers(known)
        self.clear()

    def clear(self) -> None:
        self.number.forget()
        self.words: list[np.ndarray] = []
        self.n = 0
        self.docs: list[int] = []
        self.ids: list[tuple] = []
        self.kinds: list[int] = []

    def add(self, who: tuple, kind: int, text: str | None) -> Iterator[bytes]:
        """Takes in a text; when the run is full, gives it."""
        self.ids.append(who), self.kinds.append(kind)
        before, done = ["", ""], not text
        whole = len(text or "") < 4 * RUN  # longer ones are cut into slices of words
        found = iter(()) if whole or not text else _WORD.finditer(text)
        while not done:
            some = _WORD.findall(text) if whole else [m.group() for m in islice(found, RUN)]
            done = whole or len(some) < RUN
            row = [*before, *some, *([_AFTER] if done else [])]
            before = row[-2:]
            self.words.append(np.fromiter(map(self.number.__getitem__, row), np.int32, len(row)))
            self.docs.append(len(self.ids) - 1)
            self.n += len(row)
            if self.n >= RUN:
                yield from self.blob()
                if not done:  # the rest of the text begins the next run
                    self.ids.append(who), self.kinds.append(kind | 4)

    def blob(self) -> Iterator[bytes]:
        """The run, packed, if there is any; then it is empty."""
        if self.ids:
            rare = self.number.rare
            hashes = np.array([self.code.hashed(w) for w in rare], np.uint64)
            who, more = (np.array(v, np.int64) for v in zip(*self.ids, strict=True))
            sizes, flat = np.array([len(w) for w in self.words], np.int32), np.concatenate([np.empty(0, np.int32), *self.words])
            yield _packed(who, more, np.array(self.kinds, np.uint8), sizes, np.array(self.docs, np.int32), flat, hashes, self.code.costs(rare))
        self.clear()


def encoded_runs(docs: DataFrame, known, coder: Callable[[], Coder]) -> Brief:
    """(first, blob): the documents (who, more, kind, text) as runs of numbered words, each with a number of its own."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, place = _Run(known.value, coder()), TaskContext.get().partitionId() << 33

        def blobs() -> Iterator[bytes]:
            for batch in batches:
                ids = zip(*(batch.column(n).to_pylist() for n in ("who", "more", "kind")), strict=True)
                for (who, more, kind), text in zip(ids, texts_of(batch.column("text")), strict=True):
                    yield from run.add((who, more), kind, text)
            yield from run.blob()

        for number, blob in enumerate(blobs(), place):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([blob], pa.binary())], ["first", "blob"])
        pa.default_memory_pool().release_unused()

    rows = docs.select("who", "more", "kind", "text").mapInArrow(mapped, "first long, blob binary")
    return brief(rows, {"parquet.block.size": ENCODED})


def _dealt(blob: bytes, known: Frequent, shards: int, now: int, training: bool) -> Iterator[tuple]:
    """(shard, blob) of the trigrams of a run in the shards of pass ``now`` and, with shard -1, of its documents."""
    who, more, kinds, sizes, docs, flat, rare, cost = _unpacked(blob, *_RUN)
    if not training:
        yield -1, _packed(who, more, kinds)
    if not len(flat):
        return
    first = len(known.hashes)
    hashes = np.concatenate([known.hashes, rare])
    parts = np.concatenate([known.parts, np.ones(len(rare), np.int64)])
    begins = np.concatenate([known.shard, _scaled(_mixed(rare), shards)])
    last = np.ones(len(flat), bool)
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    last[starts] = last[starts + 1] = False
    doc = np.repeat(docs, sizes - 2)
    at = np.flatnonzero(last)
    here = ((begins % PASSES == now) | (parts > 1))[flat[at - 1]]
    if training:  # only what is trusted or asks for a fact, and no document
        kind = kinds[doc]
        here &= (kind & 2 > 0) | (flat[at] >= first) | (parts[flat[at - 1]] > 1)
    at, doc = at[here], doc[here]
    a, b, c = flat[at - 2], flat[at - 1], flat[at]
    shard = begins[b]
    cut = np.flatnonzero(parts[b] > 1)
    shard[cut] = (shard[cut] + _scaled(keys(3, hashes[a[cut]], hashes[c[cut]]), parts[b[cut]])) % shards
    own = shard % PASSES == now
    doc, a, b, c, shard = (x[own] for x in (doc, a, b, c, shard))
    if not len(a):
        return
    kind = kinds[doc]
    if training:
        kind = np.where(kind & 2 > 0, kind & 3, 0).astype(np.uint8)
        doc = kind
    one, times = _distinct(doc, a, b, c)
    one = one[np.argsort(shard[one].astype(np.uint16 if shards < 1 << 16 else np.int64), kind="stable")]
    doc, kind, a, b, c, shard, times = (x[one] for x in (doc, kind, a, b, c, shard, times))
    if training:
        doc, cost = np.zeros(len(a), np.int32), np.zeros(len(rare), np.float32)
    others = [x >= first for x in (a, b, c)]
    numbers = [np.where(other, FREQUENT, x).astype(np.uint16) for other, x in zip(others, (a, b, c), strict=True)]
    edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    for x, y in zip(edges, edges[1:], strict=False):
        i = slice(x, y)
        seldom = [v[i][other[i]] - first for v, other in zip((a, b, c), others, strict=True)]
        delta = np.diff(doc[i], prepend=np.int32(0)).astype(np.int32)
        yield int(shard[x]), _packed(delta, kind[i], times[i], *(v[i] for v in numbers), rare[np.concatenate(seldom)], cost[seldom[2]])


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows that are different, in ascending order, and how often each place's row comes (0 for other places). Rare equal rows may stay apart."""
    key = np.zeros(len(columns[0]), np.uint64)
    for column, factor in zip(columns, (*_KEYS, 0xD6E8FEB86659FD93), strict=True):
        key += column.astype(np.uint64) * np.uint64(factor)
    order = np.argsort(key)
    new = np.ones(len(order), bool)
    new[1:] = False
    for column in columns:  # equal keys of different rows are told apart here
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    begins = np.flatnonzero(new)
    times = np.zeros(len(order), np.int32)
    times[order[begins]] = np.diff(begins, append=len(order))
    return np.flatnonzero(times), times


def _scaled(h: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.asarray(n).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def sent(runs: DataFrame, known, shards: int, now: int, training: bool) -> DataFrame:
    """(shard, first, blob) of encoded runs: their trigrams in the shards of pass ``now``, for training only what counts or asks there."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run in zip(batch.column("first").to_pylist(), batch.column("blob"), strict=True):
                if made := list(_dealt(run.as_py(), known.value, shards, now, training)):
                    columns = [pa.array([s for s, _ in made], pa.int64()), pa.array([first] * len(made), pa.int64()), pa.array([b for _, b in made], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "first", "blob"])
        pa.default_memory_pool().release_unused()

    return runs.mapInArrow(mapped, "shard long, first long, blob binary")


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the number of the group of its key, and for each group one of its places."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    of = np.empty(len(key), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return of, order[new]


def _kinds(of: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` contexts the total of the counts ``n`` of its n-grams, and how many are one, two and more."""
    return np.array([np.bincount(of, w, size).astype(np.int64) for w in (n, n == 1, n == 2, n > 2)])


class _Shard:
    """The trigrams of one shard, and the counts of the trusted ones of a half.

    ``doc``, ``run``, ``kind``, ``times`` and ``third`` (the number of its trigram) tell of each row. Trigrams ``a b`` and their ``pair``, pairs (``b c``) and
    contexts are numbered; all that does not depend on a row is held once for each of these.
    """

    def __init__(self, blobs: list[pa.Buffer], known: Frequent) -> None:
        lengths = [int(np.frombuffer(blob, np.int64, 2)[1]) for blob in blobs]
        n, at = sum(lengths), 0
        self.doc, self.kind, self.times = np.empty(n, np.int32), np.empty(n, np.uint8), np.empty(n, np.int32)
        grams, base, number = [np.empty(n, np.uint64) for _ in range(3)], np.empty(n), np.empty(n, np.uint16)
        for blob, length in zip(blobs, lengths, strict=True):
            doc, kind, times, *numbers, rare, cost = _unpacked(blob, *_GRAMS)
            i = slice(at, at + length)
            at, used = at + length, 0
            self.doc[i], self.kind[i], self.times[i], number[i] = np.cumsum(doc), kind, times, numbers[2]
            for own, of in zip(grams, numbers, strict=True):
                other = np.flatnonzero(of == FREQUENT)
                of[other] = 0
                h = known.hashes[of]
                h[other] = rare[used : used + len(other)]
                used += len(other)
                own[i] = h
            h = known.base[numbers[2]]
            h[other] = cost
            base[i] = h
        self.run = np.repeat(np.arange(len(blobs), dtype=np.int32), lengths)
        key = np.empty(n, np.uint64)
        for x in range(0, n, SLICE):
            key[x : x + SLICE] = keys(3, *(g[x : x + SLICE] for g in grams))
        self.third, one = _groups(key)
        del key
        self.a, self.b, c = (g[one] for g in grams)
        base, number = base[one], number[one]
        del grams
        self.left, self.left_one = _groups(keys(2, self.a, self.b))
        self.pair, one = _groups(keys(1, self.b, c))
        self.second, self.c, self.base, self.number = self.b[one], c[one], base[one], number[one]
        self.middle, one = _groups(self.second)
        self.middles = self.second[one]
        place = np.minimum(np.searchsorted(known.hot, self.middles), max(len(known.hot) - 1, 0))
        cut = known.hot[place] == self.middles if len(known.hot) else np.zeros(len(self.middles), bool)
        self.pair_cut = cut[self.middle]
        self.cut = self.pair_cut[self.pair]
        self.left_cut = self.cut[self.left_one]

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What other shards know too, by the hash of a word in ascending order: words that are not frequent, places of hot pairs, and of hot contexts."""
        pairs, contexts = np.flatnonzero(self.pair_cut), np.flatnonzero(self.left_cut)
        one = self.left_one[contexts]
        pairs = pairs[np.lexsort((self.second[pairs], self.c[pairs]))]
        return np.unique(self.c[self.number == FREQUENT]), pairs, contexts[np.lexsort((self.b[one], self.a[one]))]

    def counted(self, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a half: n of each trigram; total, ones, twos and more of each context; n of each pair."""
        at = np.flatnonzero(self.kind & 3 == side + 2)
        n3 = np.bincount(self.third[at], self.times[at], len(self.pair)).astype(np.int64)
        seen = np.flatnonzero(n3)
        return n3, _kinds(self.left[seen], n3[seen], len(self.left_one)), np.bincount(self.pair[seen], minlength=len(self.c))


def _found(wanted: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of the sorted keys ``known`` for the wanted ones, 0 for others; ``values`` may have several rows."""
    if not len(known):
        return np.zeros((*values.shape[:-1], len(wanted)), values.dtype)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[..., at], 0)


def _shards(rows: DataFrame, made: Callable, schema: str, parts: int, by: str = "shard") -> DataFrame:
    """What ``made`` gives for the rows (as one table) of each shard; rows of a shard come together, and those below 0 go by."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            own = batch.column(by).to_numpy()
            edges = np.flatnonzero(np.diff(own, prepend=own[:1] - 1, append=own[-1:] + 1)) if len(own) else []
            for x, y in zip(edges, edges[1:], strict=False):
                if own[x] != now and held:
                    yield from made(now, pa.Table.from_batches(held))
                    held = []
                now = int(own[x])
                held.append(batch.slice(x, y - x))
        if held:
            yield from made(now, pa.Table.from_batches(held))
        pa.default_memory_pool().release_unused()

    places = [F.when(F.col("shard") < 0, F.col("first"))] if by == "shard" else []
    return rows.repartition(parts, by, *places).sortWithinPartitions(by).mapInArrow(mapped, schema)


_FACTS = "what int, key long, shard int, part int, blob binary, " + ", ".join(f"{x} long" for x in _X)


def _told(what: int, key: list[int] | np.ndarray, *x: list[int] | np.ndarray) -> pa.RecordBatch:
    """Rows of facts that are summed by (what, key)."""
    n = len(key)
    columns = [pa.array(np.full(n, what, np.int32)), pa.array(np.asarray(key, np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
    columns += [pa.array(np.asarray(v, np.int64)) for v in x] + [pa.nulls(n, pa.int64())] * (8 - len(x))
    return pa.RecordBatch.from_arrays(columns, ["what", "key", "shard", "part", "blob", *_X])


def _asked(shard: list[int], part: list[int], blob: list[bytes]) -> pa.RecordBatch:
    n = len(blob)
    columns = [pa.array(np.full(n, _ASKED, np.int32)), pa.nulls(n, pa.int64()), pa.array(shard, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, *[pa.nulls(n, pa.int64())] * 8], ["what", "key", "shard", "part", "blob", *_X])


def _ones(n: np.ndarray) -> list[list[int]]:
    return [[int((n == i).sum())] for i in (1, 2, 3, 4)]


def n_parts(shards: int) -> int:
    """Facts are summed in so many parts by the hash of a word."""
    return max(LEAST_SHARDS, shards // 4)


def facts(grams: DataFrame, known, shards: int) -> DataFrame:
    """What shards tell and ask: rows to be summed (what, key, x0 to x7), and for each part packed facts (shard, part, blob)."""
    parts = n_parts(shards)

    def made(shard: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        s = _Shard([blob.as_buffer() for blob in table.column("blob")], known.value)
        halves = [s.counted(side) for side in (0, 1)]
        own = ~s.pair_cut
        for side, (n3, _, n2) in enumerate(halves):
            for what, n in ((_THIRD, n3), (_SECOND, n2[own])):
                yield _told(what, [side], *_ones(n))
        before = [np.unique(s.c[own & (n2 > 0)], return_counts=True) for _, _, n2 in halves]
        numbers = np.unique(s.number[s.number < FREQUENT])
        numbered = [_found(known.value.hashes[numbers], *b) for b in before]
        some = np.flatnonzero(numbered[0] + numbered[1])
        some = some[np.argsort(known.value.hashes[numbers[some]])]
        numbers, numbered = numbers[some], [n[some] for n in numbered]
        rare, pairs, contexts = s.asked()
        one = s.left_one[contexts]
        hot = [np.searchsorted(known.value.hot, v) for v in (s.second[pairs], s.b[one])]
        tables = [  # each by the hash of a word, in ascending order
            (known.value.hashes[numbers], [numbers, *numbered]),
            (rare, [rare, *[_found(rare, *b) for b in before]]),
            (s.c[pairs], [s.c[pairs], hot[0], *[n2[pairs] for _, _, n2 in halves]]),
            (s.a[one], [s.a[one], hot[1], *[x for _, left, _ in halves for x in left[:, contexts]]]),
        ]
        cuts = [np.searchsorted(_scaled(key, parts), np.arange(parts + 1)) for key, _ in tables]
        blobs, places = [], []
        for part in range(parts):
            columns = [v[at[part] : at[part + 1]] for at, (_, values) in zip(cuts, tables, strict=True) for v in values]
            if any(len(v) for v in columns):
                columns = [np.diff(v, prepend=np.uint64(0)) if kind is np.uint64 else v.astype(kind) for v, kind in zip(columns, _TOLD, strict=True)]
                blobs.append(_packed(*columns)), places.append(part)
        yield _asked([shard] * len(blobs), places, blobs)

    return _shards(grams, made, _FACTS, max(shards // PASSES, 2))


class Sums:
    """What all shards need: discounts and totals of both halves, words before the frequent ones, contexts of hot middle words."""

    def __init__(self, known: Frequent) -> None:
        self.cuts = np.full((2, 4, 4), 0.5)  # half, order, count (up to 3)
        self.before, self.total, self.rest = np.zeros((2, FREQUENT), np.int64), np.zeros(2), np.ones(2)
        self.middle = np.zeros((2, 4, len(known.hot)), np.int64)


def _totals(of: np.ndarray, size: int, values: np.ndarray) -> np.ndarray:
    return np.array([np.bincount(of, v, size).astype(np.int64) for v in values])


def added(told: DataFrame, known, parts: int) -> DataFrame:
    """Facts summed by word, hot pair and hot context in parts: rows to be summed, and for each shard the sums in the order of its questions (shard, part, blob)."""

    def made(part: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        asking, rows = table.column("shard").to_pylist(), [_unpacked(blob.as_buffer(), *_TOLD) for blob in table.column("blob")]
        sizes = [[len(r[i]) for r in rows] for i in (3, 6, 10)]
        for r in rows:
            for i in (3, 6, 10):
                r[i] = np.cumsum(r[i], dtype=np.uint64)
        numbers, n0, n1, rare, r0, r1, last, hot, p0, p1, first, middle, *c = (np.concatenate(v) for v in zip(*rows, strict=True))
        del rows
        hots = known.value.hot if len(known.value.hot) else np.zeros(1, np.uint64)
        pair, one = _groups(keys(1, hots[hot], last))
        pairs = _totals(pair, len(one), np.array([p0, p1]))
        word = np.concatenate([rare, known.value.hashes[numbers], last[one]])
        of, places = _groups(word)
        words = _totals(of, len(places), np.concatenate([[r0, r1], [n0, n1], pairs > 0], axis=1))
        for side in (0, 1):
            yield _told(_SECOND, [side], *_ones(pairs[side]))
            yield _told(_FIRST, [side], *_ones(words[side]), [int(words[side].sum())], [int((words[side] > 2).sum())])
        kinds = np.concatenate([_kinds(hot[one], n, len(hots)) for n in pairs])
        some = np.flatnonzero(kinds.any(axis=0))
        yield _told(_MIDDLE, some, *kinds[:, some])
        order = np.argsort(known.value.hashes)
        ordered = known.value.hashes[order]
        at = np.minimum(np.searchsorted(ordered, word[places]), len(ordered) - 1)
        frequent = np.flatnonzero(ordered[at] == word[places])
        yield _told(_NUMBERED, order[at[frequent]], *words[:, frequent])
        context, one = _groups(keys(2, first, hots[middle]))
        contexts = _totals(context, len(one), np.array(c))
        ends = [np.cumsum([0, *n]) for n in sizes]
        found = [(of[: len(rare)], words), (pair, pairs), (context, contexts)]
        blobs = [_packed(*[v for end, (g, values) in zip(ends, found, strict=True) for v in values[:, g[end[i] : end[i + 1]]]]) for i in range(len(asking))]
        yield _asked(asking, [part] * len(blobs), blobs)

    return _shards(told.filter(F.col("what") == _ASKED).select("shard", "part", "blob"), made, _FACTS, parts, "part")


def summed(told: DataFrame, more: DataFrame, known: Frequent, discounts: Callable) -> Sums:
    """The sums of what shards and parts tell: some numbers, at most FREQUENT rows and those of hot words."""
    out = Sums(known)
    rows = told.union(more).filter(F.col("what") != _ASKED).groupBy("what", "key").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in _X])
    for what, key, *x in rows.collect():
        if what == _NUMBERED:
            out.before[:, key] = x[:2]
        elif what == _MIDDLE:
            out.middle[:, :, key] = np.reshape(x, (2, 4))
        else:
            cut = out.cuts[key, 3 if what == _THIRD else 2 if what == _SECOND else 1, 1:] = discounts(*x[:4])
            if what == _FIRST:
                ones, total, many = x[:4], x[4], x[5]
                out.total[key] = total
                out.rest[key] = (cut[0] * ones[0] + cut[1] * ones[1] + cut[2] * many) / total if total else 1.0
    return out


def _spread(cuts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """What the discounts of a context leave, by its ones, twos and more."""
    return cuts[1] * kinds[1] + cuts[2] * kinds[2] + cuts[3] * kinds[3]


def _costs(s: _Shard, side: int, at: np.ndarray, sums: Sums, known: Frequent, told: tuple) -> np.ndarray:
    """Steps of negative logarithms of the probabilities of the trigrams ``at`` in the model of a half."""
    rare, before, pairs, pair_totals, contexts, context_totals = told
    n3, left, n2 = s.counted(side)
    middles = _kinds(s.middle[~s.pair_cut], n2[~s.pair_cut], len(s.middles))
    n2[pairs] = pair_totals[side]
    left[:, contexts] = context_totals[4 * side : 4 * side + 4]
    cuts = sums.cuts[side]

    def mixed(n: np.ndarray, cuts: np.ndarray, total: np.ndarray, rest: np.ndarray, lower: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.log((n - cuts[np.minimum(n, 3)] * (n > 0)) / total)
            return np.where(total > 0, np.logaddexp(p, np.log(rest / total) + lower), lower)

    def some(of: np.ndarray, size: int) -> Iterator[np.ndarray]:
        found = np.flatnonzero(np.bincount(of, minlength=size))
        return (found[x : x + SLICE] for x in range(0, len(found), SLICE))

    second, out = np.empty(len(s.c)), np.empty(len(s.pair), np.int64)
    for i in some(s.pair[s.third[at]], len(s.c)):
        number, total = s.number[i], np.full(len(i), sums.total[side])
        common = number < FREQUENT
        n = np.where(common, sums.before[side][np.where(common, number, 0)], _found(s.c[i], rare, before[side]))
        logs = mixed(n, cuts[1], total, sums.rest[side] * total, -s.base[i])
        n, kinds, cut = n2[i], middles[:, s.middle[i]], np.flatnonzero(s.pair_cut[i])
        kinds[:, cut] = _found(s.second[i[cut]], known.hot, sums.middle[side])
        second[i] = mixed(n, cuts[2], kinds[0], _spread(cuts[2], kinds), logs)
    for i in some(s.third[at], len(s.pair)):
        kinds = left[:, s.left[i]]
        logs = mixed(n3[i], cuts[3], kinds[0], _spread(cuts[3], kinds), second[s.pair[i]])
        out[i] = np.rint(-logs * _STEPS).astype(np.int64)
    return out[s.third[at]]


def _answers(s: _Shard, table: pa.Table) -> tuple:
    """What the shard asked for, and the sums of all shards for it: two of words and pairs, eight of contexts."""
    found = [_unpacked(blob.as_buffer(), *[np.int64] * 12) for blob in table.sort_by("part").column("blob")]
    columns = [np.concatenate(v) for v in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 12
    out = [x for own, i, j in zip(s.asked(), (0, 2, 4), (2, 4, 12), strict=True) for x in (own, np.array(columns[i:j]))]
    if any(len(own) != values.shape[1] for own, values in zip(out[::2], out[1::2], strict=True)):
        raise ValueError("a shard has other words than in the first phase")
    return tuple(out)


def costs(grams: DataFrame, answers: DataFrame, sums, known, shards: int) -> DataFrame:
    """(first, blob): for each run the documents, and the costs of its trigrams in one shard by document."""
    rows = grams.select("shard", "first", "blob", F.lit(None).cast("int").alias("part"))
    rows = rows.union(answers.select(F.col("shard").cast("long"), F.lit(None).cast("long"), "blob", "part"))

    def made(shard: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        asked = table.column("part").is_null()
        blobs = table.filter(asked)
        if not len(blobs):
            return
        firsts = blobs.column("first").to_pylist()
        if shard < 0:
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array([0] * len(firsts), pa.int32()), blobs.column("blob").combine_chunks()], ["first", "kind", "blob"])
            return
        s = _Shard([blob.as_buffer() for blob in blobs.column("blob")], known.value)
        told = _answers(s, table.filter(table.column("part").is_valid()))
        cost = np.zeros(len(s.doc), np.int64)
        for side in (0, 1):
            at = np.flatnonzero(s.kind & 1 == 1 - side)
            if len(at):
                cost[at] = _costs(s, side, at, sums.value, known.value, told) * s.times[at]
        new = np.flatnonzero((np.diff(s.doc, prepend=-1) != 0) | (np.diff(s.run, prepend=-1) != 0))
        cost, doc, run = np.add.reduceat(cost, new), s.doc[new], s.run[new]
        edges = np.flatnonzero(np.diff(run, prepend=-1, append=-1))
        out = [_packed(np.diff(doc[x:y], prepend=0).astype(np.int64), cost[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array([1] * len(out), pa.int32()), pa.array(out, pa.binary())], ["first", "kind", "blob"])

    return _shards(rows, made, "first long, kind int, blob binary", max(shards // PASSES, 2))


def gathered(parts: DataFrame, shards: int) -> DataFrame:
    """(who, more, copies, steps): the costs of each run summed by document."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, total = None, None, None

        def out() -> pa.RecordBatch:
            who, more, kinds = ids
            return pa.RecordBatch.from_arrays([pa.array(who), pa.array(more), pa.array((kinds < 4).astype(np.int64)), pa.array(total)], ["who", "more", "copies", "steps"])

        for batch in batches:
            for first, kind, blob in zip(*(batch.column(n).to_pylist() for n in ("first", "kind", "blob")), strict=True):
                if first != now and ids is not None:
                    yield out()
                if not kind:  # the documents of a run come first
                    now, ids = first, _unpacked(blob, np.int64, np.int64, np.uint8)
                    total = np.zeros(len(ids[0]), np.int64)
                else:
                    doc, cost = _unpacked(blob, np.int64, np.int64)
                    total[np.cumsum(doc)] += cost
        if ids is not None:
            yield out()

    rows = parts.repartition(max(shards // PASSES, 2), "first").sortWithinPartitions("first", "kind")
    return rows.mapInArrow(mapped, "who long, more long, copies long, steps long").groupBy("who", "more").agg(F.sum("copies").alias("copies"), F.sum("steps").alias("steps"))


def n_shards(docs: DataFrame) -> int:
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return max(LEAST_SHARDS, -(-chars // (CHARS * SHARD)))


def scored(docs: DataFrame, coder: Callable[[], Coder], discounts: Callable) -> DataFrame:
    """(who, more, nll) of the different documents (who, more, half, trusted, text): the sum of negative logarithms."""
    spark = docs.sparkSession
    marked = docs.select("who", "more", (F.col("half") + F.when(F.col("trusted"), 2).otherwise(0)).alias("kind"), "text")
    shards = n_shards(docs)
    with thrifty(spark, {"spark.sql.files.maxPartitionBytes": str(ENCODED), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH)}):
        words = frequent(marked, coder, shards)
        known = spark.sparkContext.broadcast(words)
        runs = encoded_runs(marked, known, coder)
        told = [brief(facts(sent(runs.table, known, shards, now, True), known, shards)) for now in range(PASSES)]
        every = reduce(DataFrame.union, [t.table for t in told])
        answers = brief(added(every, known, n_parts(shards)))
        sums = summed(every, answers.table, words, discounts)
        for done in told:
            done.delete()
        model = spark.sparkContext.broadcast(sums)
        passes = []
        for now in range(PASSES):
            grams = sent(runs.table, known, shards, now, False)
            own = answers.table.filter((F.col("what") == _ASKED) & (F.pmod(F.col("shard"), F.lit(PASSES)) == now))
            passes.append(brief(gathered(costs(grams, own, model, known, shards), shards)))
        every = reduce(DataFrame.union, [p.table for p in passes])
        nll = F.sum("steps") / F.lit(float(_STEPS)) / (F.sum("copies") / F.lit(float(PASSES)))
        out = settle(every.groupBy("who", "more").agg(nll.alias("nll")))
        for done in (runs, *passes, answers):
            done.delete()
    return out
