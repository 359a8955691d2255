"""Near duplicates by SimHash fingerprints and vantage-point trees.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles. Equal fingerprints are one class. Classes are dealt
to shards by the leaves of a vantage-point tree: each node has a fingerprint as its vantage point and the median Hamming distance to it;
the nearer half goes left, the farther half right. A class belongs to one leaf and also visits every leaf that the triangle inequality
does not exclude for its search radius, so that each linked pair meets in one shard and no pair is lost. Within a shard the search
goes on over rings around further vantage points, pruned by the same bound, and what is left is compared in blocks. A shard gives each of
its linked classes the smallest member of its local component, never pairs; components across shards come from alternating large and small stars.

Each shard has at most about ``shard`` classes of its own: leaves that hold more, as large groups of near copies do, are cut into blocks
by hash, and visitors go to all blocks. Visitors of a shard are cut into parts as well. Both only bound the memory of a task.

Defined results: null and empty texts have the fingerprint zero and are linked like any other; texts with fewer words than a shingle are one
shingle; repeated rows each get a result; null ids come last when a representative is chosen; an empty table gives an empty table. Only doc_id and text
are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import lowered, map_texts, packed, unpacked
from corpusflow.session import settle

SEED = 42
SHARD = 1 << 15
VISITORS = 1 << 20
SAMPLE = 1 << 13
DEEPEST = 8
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]
_LEAF = 1024


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; A-Z lower-cased, words joined by one space."""
    words = lowered(text).split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = [n - 1 for n in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[: max(0, len(words) - shingle)])]
    digest = xxhash.xxh64_intdigest
    hashed = [digest(line[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :], strict=True)]
    return np.array(hashed, np.uint64)


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """Majority bits, most significant first; beyond 64 bits the hashes are mixed anew for each further word."""
    n, out = len(hashes), []
    if not n:
        return bytes(8 * words)
    for word in range(words):
        h = hashes if not word else _mixed(hashes + np.uint64(0x9E3779B97F4A7C15 * word & (1 << 64) - 1))
        # Eight counters of a byte each in a word; a block of 255 hashes cannot overflow them.
        lanes = np.add.reduceat((h >> _SHIFTS) & _LANES, np.arange(0, n, 255), axis=1)
        counts = lanes.astype("<u8").view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64).T  # byte, bit
        out.append(np.packbits(2 * counts.ravel() > n, bitorder="little").tobytes()[::-1])
    return b"".join(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 4, words: int = 1) -> DataFrame:
    """The columns ``keep`` with ``fp`` and the number of shingles."""

    def each(text: str | None) -> tuple:
        hashes = shingle_hashes(text, shingle)
        return fingerprint(hashes, words), len(hashes)

    return map_texts(docs, keep, "text", each, {"fp": "binary", "shingles": "long"})


def _matrix(fps: pa.Array | list[bytes], words: int) -> np.ndarray:
    """Fingerprints as rows of 64-bit numbers."""
    if isinstance(fps, list):
        data = np.frombuffer(b"".join(fps), np.uint8)
    elif not len(fps):
        data = np.empty(0, np.uint8)
    else:  # the bytes of an Arrow column lie one after the other
        width = np.int64 if pa.types.is_large_binary(fps.type) else np.int32
        _, offsets, values = fps.buffers()
        ends = np.frombuffer(offsets, width)[fps.offset : fps.offset + len(fps) + 1]
        data = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]]
    return data.view(">u8").astype(np.uint64).reshape(-1, words)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


class Tree:
    """The upper levels of a vantage-point tree; leaves are numbered from left to right."""

    def __init__(self, sample: np.ndarray, levels: int, radius: int) -> None:
        self.radius, self.leaves, self.seed = radius, 0, np.random.default_rng(SEED)
        self.root = self._build(sample, levels)

    def _build(self, points: np.ndarray, levels: int):
        if levels and len(points) > 1:
            tries = points[self.seed.choice(len(points), min(8, len(points)), replace=False)]
            pivot = max(tries, key=lambda p: float(_distance(points, p).var()))
            d = _distance(points, pivot)
            cut = int(np.median(d))
            if (d <= cut).any() and (d > cut).any():
                return pivot, cut, self._build(points[d <= cut], levels - 1), self._build(points[d > cut], levels - 1)
        self.leaves += 1
        return self.leaves - 1

    def homes(self, fps: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fps), np.int64)
        self._walk(self.root, fps, np.arange(len(fps)), 0, lambda at, leaf: out.__setitem__(at, leaf))
        return out

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for each leaf that may hold a fingerprint within the radius."""
        rows, leaves = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

        def found(at, leaf):
            rows.append(at)
            leaves.append(np.full(len(at), leaf))

        self._walk(self.root, fps, np.arange(len(fps)), self.radius, found)
        return np.concatenate(rows), np.concatenate(leaves)

    def _walk(self, node, fps, at, reach, found) -> None:
        if not len(at):
            return
        if isinstance(node, int):
            found(at, node)
            return
        pivot, cut, left, right = node
        d = _distance(fps[at], pivot)
        self._walk(left, fps, at[d - reach <= cut], reach, found)
        self._walk(right, fps, at[d + reach > cut], reach, found)


class Local:
    """Components of one shard: its own points against its points and visitors."""

    def __init__(self, fps: np.ndarray, n_points: int, radius: int, coarse: tuple[int, int] | None = None) -> None:
        self.fps, self.radius, self.root = fps, radius, np.arange(len(fps))
        self.words, self.first = coarse or (fps.shape[1], radius)
        self.seed = np.random.default_rng(SEED)
        self._search(np.arange(len(fps)), np.arange(n_points), 0)

    def _search(self, q: np.ndarray, p: np.ndarray, depth: int) -> None:
        if not len(q) or not len(p):
            return
        if len(p) <= _LEAF or depth == 8:
            self._compare(q, p)
            return
        pivot = self.fps[p[self.seed.integers(len(p))]]
        dp, dq = _distance(self.fps[p], pivot), _distance(self.fps[q], pivot)
        p, q = p[np.argsort(dp, kind="stable")], q[np.argsort(dq, kind="stable")]
        dp, dq = np.sort(dp), np.sort(dq)
        cuts = np.unique(dp[np.linspace(0, len(dp) - 1, 9).astype(int)][1:])
        edges = [0, *np.searchsorted(dp, cuts, "right")]
        rings = []
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                lo, hi = np.searchsorted(dq, dp[a] - self.radius, "left"), np.searchsorted(dq, dp[b - 1] + self.radius, "right")
                rings.append((q[lo:hi], p[a:b]))
        left = sum(len(x) * len(y) for x, y in rings)
        if left > 0.9 * len(q) * len(p):  # the bound excludes too little to go on
            self._compare(q, p)
        else:
            for x, y in rings:
                self._search(x, y, depth + 1)

    def _compare(self, q: np.ndarray, p: np.ndarray) -> None:
        step = max(1, (1 << 20) // max(1, min(len(p), _LEAF)))
        for a in range(0, len(p), _LEAF):
            ps = p[a : a + _LEAF]
            columns = self.fps[ps]
            for b in range(0, len(q), step):
                qs = q[b : b + step]
                rows = self.fps[qs]
                d = np.bitwise_count(rows[:, None, 0] ^ columns[None, :, 0])
                for w in range(1, self.words):
                    d = d.astype(np.uint16) if w == 1 else d
                    d += np.bitwise_count(rows[:, None, w] ^ columns[None, :, w])
                near = d <= self.first
                if np.count_nonzero(near) > len(qs) + len(ps):
                    near &= self.root[qs][:, None] != self.root[ps][None, :]
                self._link(qs, ps, *np.nonzero(near))

    def _link(self, qs: np.ndarray, ps: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Join the pairs that are near on all words, a part at a time; pairs that are joined already need no look."""
        for begin in range(0, len(x), 1 << 15):
            a, b = qs[x[begin : begin + (1 << 15)]], ps[y[begin : begin + (1 << 15)]]
            if self.words < self.fps.shape[1]:
                apart = self.root[a] != self.root[b]
                a, b = a[apart], b[apart]
                close = _distance(self.fps[a], self.fps[b]) <= self.radius
                a, b = a[close], b[close]
            if len(a):
                self._union(a, b)

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(root, up := root[root]):
                root[:] = up


def links(
    classes: DataFrame, radius: int, words: int = 1, ratio: float | None = None, shard: int = SHARD, coarse: tuple[int, int] | None = None
) -> DataFrame:
    """Edges (a, b) between fingerprints that connect each component of fingerprints within ``radius`` of each other.

    ``classes`` has distinct ``fp`` and, if a ``ratio`` is given, ``shingles``: only classes whose numbers of shingles are at least in that
    ratio are compared. That is the triangle bound of the empty text: texts of similarity s have sizes in the ratio s at least. With ``coarse``
    (n, r), only pairs within r on their first n words are compared whole.
    """
    spark = classes.sparkSession
    band = F.floor(F.log(F.greatest(F.col("shingles"), F.lit(1))) / F.lit(-math.log(ratio) if ratio else 1.0)) if ratio else F.lit(0)
    banded = settle(classes.select("fp", band.cast("int").alias("band")))
    total = banded.count()
    if not total:
        return spark.createDataFrame([], "a binary, b binary")
    sample = [r.fp for r in banded.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()]
    levels = min(DEEPEST, max(0, math.ceil(math.log2(total / shard))))
    tree = Tree(_matrix(sample, words), levels, radius)  # at most 2 ** DEEPEST nodes, sent with the functions
    share = len(tree.visits(_matrix(sample, words))[0]) / (len(sample) * tree.leaves)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.homes(_matrix(batch.column("fp"), words))
            yield pa.RecordBatch.from_arrays([batch.column("fp"), batch.column("band"), pa.array(leaf, pa.int64())], ["fp", "band", "leaf"])

    homes = banded.mapInArrow(at_home, "fp binary, band int, leaf long")
    spread = homes.groupBy("band", "leaf").count().collect()  # bands times leaves: a few thousand numbers at most
    blocks = {(r["band"], r["leaf"]): math.ceil(r["count"] / shard) for r in spread}
    first, n_units = {}, 0
    for key in sorted(blocks):
        first[key] = n_units
        n_units += blocks[key]
    parts = max(1, math.ceil(total * share / VISITORS))
    banding = bool(ratio)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each class as a point to the parts of its own unit, as a visitor to the later units that it may have links in."""
        for batch in batches:
            fps = _matrix(batch.column("fp"), words)
            bands, leaf = batch.column("band").to_numpy(), tree.homes(fps)
            mix = _mixed(fps.sum(axis=1, dtype=np.uint64))
            part = (mix >> np.uint64(32)) % np.uint64(parts)
            at, unit, of, point = [], [], [], []
            home = np.zeros(len(fps), np.int64)
            for key, n in blocks.items():
                own = (bands == key[0]) & (leaf == key[1])
                home[own] = first[key] + (mix[own] % np.uint64(n)).astype(np.int64)
            for k in range(parts):
                at.append(np.arange(len(fps))), unit.append(home), of.append(np.full(len(fps), k)), point.append(np.ones(len(fps), bool))
            rows, leaves = tree.visits(fps)
            for (b, l), n in blocks.items():
                there = rows[(leaves == l) & ((bands[rows] == b) | (banding & (bands[rows] == b - 1)))]
                for u in range(first[b, l], first[b, l] + n):
                    later = there[home[there] < u]
                    at.append(later), unit.append(np.full(len(later), u)), of.append(part[later].astype(np.int64)), point.append(np.zeros(len(later), bool))
            at = np.concatenate(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(unit)), pa.array(np.concatenate(of)), pa.array(np.concatenate(point)), batch.column("fp").take(pa.array(at))],
                ["unit", "part", "point", "fp"],
            )

    def joined(group: pa.Table) -> pa.Table:
        point = group.column("point").to_numpy()
        order = np.argsort(~point, kind="stable")
        fps = group.column("fp").combine_chunks().take(pa.array(order))
        root = Local(_matrix(fps, words), int(point.sum()), radius, coarse).root
        linked = np.flatnonzero(root != np.arange(len(root)))
        pa.default_memory_pool().release_unused()
        return pa.table({"a": fps.take(pa.array(linked)).cast(pa.binary()), "b": fps.take(pa.array(root[linked])).cast(pa.binary())})

    sent = banded.mapInArrow(dealt, "unit long, part long, point boolean, fp binary")
    return sent.groupBy("unit", "part").applyInArrow(joined, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): the smallest node of its component, by alternating large and small stars."""

    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(e.select("b", "a"))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = both.join(least, "u")
        if large:
            out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return out.filter("a <> b").distinct()

    now = settle(edges.filter("a <> b").distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = mark
        now = settle(stars(stars(now, True), False))


def grouped(
    docs: DataFrame, radius: int = 4, shingle: int = 4, words: int = 1, ratio: float | None = None, shard: int = SHARD,
    coarse: tuple[int, int] | None = None, tie: Column | None = None,
) -> DataFrame:
    """(doc_id, tie, fp, rep) of each row: ``rep`` is the first (doc_id, tie) of all rows that its fingerprint is linked to."""
    marked = docs.select("doc_id", (F.lit(None).cast("long") if tie is None else tie).alias("tie"), "text")
    fps = settle(fingerprints(marked, ["doc_id", "tie"], shingle, words))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("tie").alias("tie"))
    classes = settle(fps.groupBy("fp").agg(F.min(rank).alias("first"), F.max("shingles").alias("shingles")))
    roots = components(links(classes, radius, words, ratio, shard, coarse))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = settle(placed)
    firsts = placed.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("rep"))
    labels = placed.join(firsts, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "rep")
    return fps.join(labels, F.col("fp") == F.col("_fp")).select("doc_id", "tie", "fp", "rep")


#: The stage of a pipeline: shingles of four words, and four of 64 bits may differ.
STAGE = {"radius": 4, "shingle": 4}


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without those of which a near copy with a smaller (doc_id, place) is there.

    Places are written once with the rows, so that those judged are those removed, however the scans are split.
    """
    rows = settle(packed(docs, place=F.monotonically_increasing_id()))
    numbered = rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), "place")
    groups = grouped(numbered, tie=F.col("place"), **(STAGE | settings))
    gone = settle(groups.filter(F.col("tie") != F.col("rep.tie")).select(F.col("tie").alias("_gone")))
    return rows.join(gone, F.col("place") == F.col("_gone"), "left_anti").select(*unpacked(docs.columns))
