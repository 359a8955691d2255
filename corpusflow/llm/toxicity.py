"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is the sequence of its words, lower-cased; a run without spaces is cut into pieces of ``PIECE`` characters. Each word enters as two vectors: one for the
whole word and the mean of those for its character n-grams of three to five bytes, with marks at the ends of the word; both tables are hashed.
Two gated recurrent layers read a window of ``WINDOW`` words from both sides, attention weighs their states, and the weighted mean gives the logit of the
window. Windows overlap by ``WINDOW - STRIDE`` words, all windows of a text are scored, and the text has the largest logit, calibrated by a
logistic regression.

The network is fitted on at most ``FIT`` labelled documents of each label, chosen by a hash of the id, and on at most ``PER_TEXT`` windows of each, cut
in Spark before they are collected. In each round the window with the largest logit of a document takes its label. A tenth of these documents is kept
for the calibration, which also puts the shares of the labels right.

Defined results: a text without a word (null and empty ones too) has the share of toxic documents among those learned from as its score; a document with
several labels is toxic if one says so; labels that are null are none; of rows with equal ids one text is learned from; repeated rows each get a result; a
null id is not held out and has no label; without labels of both kinds all scores are the share, 0 if there is none; an empty table gives an empty table.
Only doc_id and text, and doc_id and toxic of the labels, are read; label, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import texts_of

WINDOW, STRIDE, PIECE = 64, 48, 20
FIT = 1500
PER_TEXT = 32
ROUNDS, STEPS = 8, 300  # rounds, and steps that a small sample has at least
DROP, DECAY = 0.5, 0.03  # share of words whose own vector is left out of a step, and what weights lose at each, against learning rare words by heart
LIMIT = 0.3
HIDDEN = 8
_WORDS, _GRAMS, _WIDTH = 1 << 14, 1 << 16, 8  # sizes of the hashed tables and width of their vectors
_KNOWN = 1 << 17
_BATCH = 512
_SLICE = 1 << 20
_WORD = re.compile(rf"\w{{1,{PIECE}}}")
_BREAK = re.compile(r"\W")
_SEGMENT = STRIDE << 10


def words(text: str | None) -> Iterator[list[str]]:
    """The words of a text in order, in lists of a bounded part of it. A part ends between words, unless one goes on for a whole further part."""
    text, begin = (text or "").lower(), 0
    while begin < len(text):
        end = begin + _SLICE
        if end < len(text):
            rest = _BREAK.search(text, end, end + _SLICE)
            end = rest.start() if rest else len(text) if end + _SLICE >= len(text) else end
        yield _WORD.findall(text, begin, end)
        begin = end


def places(n: int) -> list[int]:
    """Where the windows of n words begin; all are full unless there are fewer words."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Spelling:
    """Table rows of words: one for the word, and those of its character n-grams, at each byte up to three of them."""

    def __init__(self, found: list[str]) -> None:
        data = np.frombuffer(("<" + "><".join(found) + ">").encode("utf-8", "replace"), np.uint8)
        self.word = np.array([zlib.crc32(w.encode("utf-8", "replace")) & _WORDS - 1 for w in found], np.int64)
        self.begin = np.flatnonzero(data == ord("<"))
        ends = np.append(self.begin[1:], len(data))
        left = np.repeat(ends, ends - self.begin) - np.arange(len(data))  # bytes up to the end of the word
        padded = np.append(data, np.zeros(4, np.uint8)).astype(np.uint32)
        n, grams, holds, h = len(data), [], [], np.zeros(len(data), np.uint32)
        for i in range(5):
            h = (h + padded[i : i + n] + np.uint32(1)) * np.uint32(0x9E3779B1)
            if i >= 2:
                grams.append((((h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.int64))
                holds.append(left > i)
        self.grams, self.holds = np.array(grams), np.array(holds)
        self.counts = np.add.reduceat(self.holds.sum(axis=0), self.begin)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        held = np.zeros((self.grams.shape[1], _WIDTH), np.float32)
        for g, there in zip(self.grams, self.holds, strict=True):
            held[there] += p["grams"][g[there]]
        return np.concatenate([p["words"][self.word], np.add.reduceat(held, self.begin, axis=0) / self.counts[:, None]], axis=1)

    def back(self, d: np.ndarray, into: dict[str, np.ndarray]) -> None:
        """Add the gradient of the inputs to those of the tables."""
        np.add.at(into["words"], self.word, d[:, :_WIDTH])
        each = np.repeat(d[:, _WIDTH:] / self.counts[:, None], np.diff(self.begin, append=self.grams.shape[1]), axis=0)
        for g, there in zip(self.grams, self.holds, strict=True):
            np.add.at(into["grams"], g[there], each[there])


def started(seed: int = 0) -> dict[str, np.ndarray]:
    rnd = np.random.default_rng(seed)
    h, d = HIDDEN, 2 * _WIDTH
    draw = lambda scale, *shape: (rnd.standard_normal(shape) * scale).astype(np.float32)
    return {
        "words": draw(0.01, _WORDS, _WIDTH), "grams": draw(0.01, _GRAMS, _WIDTH), "into": draw(0.4, 2, d, 3 * h), "bias": np.zeros((2, 3 * h), np.float32),
        "own": draw(0.3, 2, h, 3 * h), "look": draw(0.3, 2 * h), "out": draw(0.3, 2 * h), "base": np.full(1, -2, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, tuple]:
    """Logits of windows; ``x`` (time, direction, window, 3 gates) is what the words give, with the second direction in reversed time, as is ``mask``."""
    steps, _, n, _ = x.shape
    k = HIDDEN
    states = np.zeros((steps + 1, 2, n, k), x.dtype)
    for t in range(steps):
        h = states[t]
        a = h @ p["own"]
        gates = _sigmoid(x[t, :, :, : 2 * k] + a[:, :, : 2 * k])
        new = np.tanh(x[t, :, :, 2 * k :] + gates[:, :, :k] * a[:, :, 2 * k :])
        move = (1 - gates[:, :, k:]) * mask[t][:, :, None]  # a state does not move where no word is
        np.add(h, move * (new - h), out=states[t + 1])
        if keep is not None:
            keep.append((a, gates, new, move))
    both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2)  # time, window, states of both directions at the same word
    look = both @ p["look"] + np.where(mask[:, 0] > 0, 0, -np.inf).astype(x.dtype)
    weight = np.exp(look - look.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tnk,tn->nk", both, weight)
    return pooled @ p["out"] + p["base"][0], (states, both, weight, pooled)


def back(p: dict[str, np.ndarray], mask: np.ndarray, kept: list, seen: tuple, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the parameters and of what the words give."""
    states, both, weight, pooled = seen
    k, steps = HIDDEN, len(kept)
    grad = {"out": pooled.T @ d_logit, "base": np.array([d_logit.sum()])}
    d_pooled = d_logit[:, None] * p["out"]
    d_weight = np.einsum("tnk,nk->tn", both, d_pooled)
    d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["look"] = np.einsum("tnk,tn->k", both, d_look)
    d_both = weight[:, :, None] * d_pooled + d_look[:, :, None] * p["look"]
    d_x = np.zeros((steps, 2, both.shape[1], 3 * k), both.dtype)
    grad["own"] = np.zeros_like(p["own"])
    d_h = np.zeros_like(states[0])
    for t in range(steps - 1, -1, -1):
        a, gates, new, move = kept[t]
        h = states[t]
        d_h = d_h + np.stack([d_both[t, :, :k], d_both[steps - 1 - t, :, k:]])
        d_new = d_h * move * (1 - new * new)
        stay = gates[:, :, k:]
        d_stay = -d_h * (new - h) * mask[t][:, :, None] * stay * (1 - stay)
        reset = gates[:, :, :k]
        d_reset = d_new * a[:, :, 2 * k :] * reset * (1 - reset)
        d_x[t] = np.concatenate([d_reset, d_stay, d_new], axis=2)
        d_a = np.concatenate([d_reset, d_stay, d_new * reset], axis=2)
        grad["own"] += h.transpose(0, 2, 1) @ d_a
        d_h = d_h * (1 - move) + d_a @ p["own"].transpose(0, 2, 1)
    return grad, d_x


def _given(table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``run`` reads, of windows of rows of a table (row, direction, gates); -1 is no word."""
    picked = table[at.T]
    mask = (at.T >= 0).astype(table.dtype)
    return np.stack([picked[:, :, 0], picked[::-1, :, 1]], axis=1), np.stack([mask, mask[::-1]], axis=1)


def gates_of(p: dict[str, np.ndarray], inputs: np.ndarray) -> np.ndarray:
    return np.einsum("wd,xdg->wxg", inputs, p["into"], optimize=True) + p["bias"]


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01) -> None:
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, grad: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grad.items():
            rows = np.flatnonzero(g.any(axis=1)) if k in ("words", "grams") else slice(None)  # rows without a gradient rest
            g = g[rows]
            self.m[k][rows] = m = 0.9 * self.m[k][rows] + 0.1 * g
            self.v[k][rows] = v = 0.999 * self.v[k][rows] + 0.001 * g * g
            move = (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
            self.p[k][rows] -= self.rate * (move + DECAY * self.p[k][rows])


def loss_gradients(p: dict[str, np.ndarray], vocabulary: list[str], windows: np.ndarray, label: np.ndarray, weight: np.ndarray, drop: np.random.Generator | None = None) -> tuple[float, dict]:
    """Mean weighted log loss of windows of word numbers, and its gradients."""
    used, at = np.unique(windows[windows >= 0], return_inverse=True)
    rows = np.full(windows.shape, -1)
    rows[windows >= 0] = at
    spelled = Spelling([vocabulary[i] for i in used])
    inputs = spelled.inputs(p)
    held = np.ones((len(used), 2 * _WIDTH), inputs.dtype)
    if drop:
        held[drop.random(len(used)) < DROP, :_WIDTH] = 0
        held[drop.random(len(used)) < DROP / 5] = 0
    inputs = inputs * held
    x, mask = _given(gates_of(p, inputs), rows)
    kept: list = []
    z, seen = run(p, x, mask, kept)
    share = weight / weight.sum()
    loss = float((share * (np.logaddexp(0, z) - label * z)).sum())
    grad, d_x = back(p, mask, kept, seen, (share * (_sigmoid(z) - label)).astype(x.dtype))
    d_gates = np.zeros((len(used), 2, 3 * HIDDEN), x.dtype)
    there = rows.T >= 0
    np.add.at(d_gates[:, 0], rows.T[there], d_x[:, 0][there])
    np.add.at(d_gates[:, 1], rows.T[there], d_x[::-1, 1][there])
    grad["into"] = np.einsum("wd,wxg->xdg", inputs, d_gates, optimize=True)
    grad["bias"] = d_gates.sum(axis=0)
    grad |= {"words": np.zeros_like(p["words"]), "grams": np.zeros_like(p["grams"])}
    spelled.back(np.einsum("wxg,xdg->wd", d_gates, p["into"], optimize=True) * held, grad)
    return loss, grad


def _logits(p: dict[str, np.ndarray], table: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Logits of windows of table rows; those with few words are run together, so that none is padded to much more than its length."""
    out = np.empty(len(windows), np.float32)
    width = np.maximum(4, 1 << np.ceil(np.log2(np.maximum((windows >= 0).sum(axis=1), 1))).astype(np.int64))
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        for begin in range(0, len(of), _BATCH):
            at = of[begin : begin + _BATCH]
            out[at] = run(p, *_given(table, windows[at][:, : min(w, WINDOW)]))[0]
    return out


def fit(texts: list[list[list[str]]], labels: np.ndarray, share: float, rounds: int = ROUNDS, seed: int = 0) -> dict[str, np.ndarray] | None:
    """The network and its calibration, from windows of words of each document; None unless both labels are there."""
    there = [i for i, t in enumerate(texts) if t]
    texts, labels = [texts[i] for i in there], np.asarray(labels, np.float32)[there]
    if not len(labels) or labels.min() == labels.max():
        return None
    numbers: dict[str, int] = {}
    windows = np.full((sum(map(len, texts)), WINDOW), -1)
    for row, words_of_window in zip(windows, (w for t in texts for w in t), strict=True):
        row[: len(words_of_window)] = [numbers.setdefault(w, len(numbers)) for w in words_of_window]
    vocabulary, doc = list(numbers), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    rnd = np.random.default_rng(seed)
    apart = np.zeros(len(texts), bool)
    for label in (0, 1):  # some of each label for the calibration, if there are enough
        own = rnd.permutation(np.flatnonzero(labels == label))
        apart[own[: len(own) // 10]] = True
    p, spelled = started(seed), Spelling(vocabulary)
    adam, n_batch = Adam(p), 64
    rounds = max(rounds, min(6 * rounds, math.ceil(STEPS * n_batch / (2 * len(texts)))))

    def scores() -> np.ndarray:
        return _logits(p, gates_of(p, spelled.inputs(p)), windows)

    for turn in range(rounds):
        z = scores() if turn else rnd.standard_normal(len(windows))
        order = np.lexsort((z, doc))
        worst = order[np.append(starts[1:], len(order)) - 1]  # the window with the largest logit of each document
        other = starts + rnd.integers(0, 1 << 30, len(starts)) % np.diff(starts, append=len(order))
        # every window of a clean document is clean; most of a toxic one are not, which is of use until the network tells them apart
        more = ~apart & ((labels == 0) | (turn < 0.6 * rounds))
        picked = np.concatenate([worst[~apart], other[more]])
        adam.rate = 0.01 if turn < 0.7 * rounds else 0.003
        for at in np.array_split(rnd.permutation(picked), max(1, len(picked) // n_batch)):
            label = labels[doc[at]]
            adam.step(loss_gradients(p, vocabulary, windows[at], label, np.ones(len(at), np.float32), rnd)[1])
    most = np.maximum.reduceat(scores(), starts)
    held = apart if len(np.unique(labels[apart])) == 2 else np.ones(len(texts), bool)
    p["scale"] = np.array(calibrated(most[held].astype(np.float64), labels[held], share))
    return p


def calibrated(z: np.ndarray, label: np.ndarray, share: float, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on logits, with labels weighted to their share; a slight pull keeps the slope finite."""
    weight = np.where(label == 1, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9)) / len(z)
    a, b = 1.0, 0.0
    pull = 1e-3
    for _ in range(steps):
        q = _sigmoid(a * z + b)
        g = np.array([(weight * (q - label) * z).sum() + pull * (a - 1), (weight * (q - label)).sum() + pull * b])
        c = weight * q * (1 - q)
        m = np.array([[(c * z * z).sum() + pull, (c * z).sum()], [(c * z).sum(), c.sum() + pull]])
        move = np.linalg.solve(m, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return max(a, 1e-3), b


def segments(text: str | None) -> Iterator[tuple[list[str], list[int]]]:
    """Words of a text in bounded lists, each with the places of its windows; together they are the windows of the whole text."""
    held: list[str] = []
    for part in words(text):
        held += part
        while len(held) > _SEGMENT + WINDOW:
            yield held[: _SEGMENT + WINDOW], list(range(0, _SEGMENT, STRIDE))
            held = held[_SEGMENT:]
    if held:
        yield held, places(len(held))


class Scorer:
    """Scores of texts; what the gates get from a word is kept for the words seen last."""

    def __init__(self, p: dict[str, np.ndarray] | None, share: float) -> None:
        self.p, self.share, self.known = p, share, {}
        self.table = np.zeros((1 << 12, 2, 3 * HIDDEN), np.float32)
        self.held: list[np.ndarray] = []
        self.of: list[int] = []
        self.most: list[float] = []

    def _rows(self, found: list[str]) -> np.ndarray:
        rows = list(map(self.known.get, found))
        if None in rows:
            if len(self.known) > _KNOWN:
                self._look()
                self.known.clear()
                rows = [None] * len(found)
            new = list(dict.fromkeys(w for w, r in zip(found, rows, strict=True) if r is None))
            n, m = len(self.known), len(self.known) + len(new)
            if m > len(self.table):
                wider = np.zeros((2 * m, 2, 3 * HIDDEN), np.float32)
                wider[:n] = self.table[:n]
                self.table = wider
            self.table[n:m] = gates_of(self.p, Spelling(new).inputs(self.p))
            self.known.update(zip(new, range(n, m), strict=True))
            rows = list(map(self.known.get, found))
        return np.array(rows, np.int64)

    def _look(self) -> None:
        if self.held:
            z = _logits(self.p, self.table, np.concatenate(self.held))
            of = np.repeat(self.of, [len(w) for w in self.held])
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for i, best in zip(of[starts].tolist(), np.maximum.reduceat(z, starts).tolist(), strict=True):
                self.most[i] = max(self.most[i], best)
        self.held, self.of = [], []

    def scores(self, texts: Iterator[str | None]) -> list[float]:
        """Scores of some texts; their windows are run together, some thousand at a time."""
        self.most, n = [], 0
        for i, text in enumerate(texts):
            self.most.append(-np.inf)
            for found, at in segments(text) if self.p else ():
                rows = self._rows(found)
                if len(rows) < WINDOW:
                    rows = np.append(rows, np.full(WINDOW - len(rows), -1))
                self.held.append(rows[np.array(at)[:, None] + np.arange(WINDOW)])
                self.of.append(i)
                n += len(at)
                if n >= 8 * _BATCH:
                    self._look()
                    n = 0
        self._look()
        scale = self.p["scale"] if self.p else (1.0, 0.0)
        return [self.share if z == -np.inf else float(_sigmoid(scale[0] * z + scale[1])) for z in self.most]


def held_out(doc_id: Column) -> Column:
    """Ids that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, n_fit: int = FIT, per_text: int = PER_TEXT, rounds: int = ROUNDS) -> tuple[dict | None, float]:
    """(network, share of toxic documents), learned from labels (doc_id, toxic) of ids that are not held out."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chance = F.xxhash64("doc_id", F.lit("fit"))
    sample = None
    for label in (0, 1):
        rows = known.filter(F.col("toxic") == label).orderBy(chance, "doc_id").limit(n_fit)
        sample = rows if sample is None else sample.union(rows)
    chosen = {r["doc_id"]: r["toxic"] for r in sample.collect()}  # at most 2 * n_fit ids
    if not chosen:
        return None, share
    # one text of each id: rows that share an id cannot make the sample larger
    ids = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "_id long"))
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                rnd = np.random.default_rng(abs(doc_id))
                kept: list[list[str]] = []
                seen = 0
                for found, at in segments(text):
                    for begin in at:  # each window with the same chance, however many there are
                        seen += 1
                        if len(kept) < per_text:
                            kept.append(found[begin : begin + WINDOW])
                        elif (place := int(rnd.integers(seen))) < per_text:
                            kept[place] = found[begin : begin + WINDOW]
                lines = pa.array([[" ".join(w) for w in kept]], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), lines], ["doc_id", "windows"])
        pa.default_memory_pool().release_unused()

    rows = sorted(texts.mapInArrow(cut, "doc_id long, windows array<string>").collect())  # bounded by n_fit and per_text
    found = [[w.split(" ") for w in r["windows"]] for r in rows]
    return fit(found, np.array([chosen[r["doc_id"]] for r in rows]), share, rounds), share


def predict(docs: DataFrame, model: tuple[dict | None, float], limit: float = LIMIT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            made = pa.array(scorer.scores(texts_of(batch.column("text"))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "score"])
        pa.default_memory_pool().release_unused()

    scored = docs.select("doc_id", "text").mapInArrow(mapped, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
