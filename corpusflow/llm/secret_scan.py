"""Secret scan: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Fixed patterns find assignments, access keys and long hexadecimal runs. Every other run of characters that keys are made of, of any length, is scored by two
first-order Markov models over characters, one of random strings and one of ordinary words, from its beginning to its end, so that its length counts too; a token whose
log-likelihood ratio is above a limit is a secret as well. Both models are trained on labelled samples: values that the fixed patterns found are random, tokens outside of
them and shorter than ``SAMPLED`` are ordinary. The models are two tables of pairs of characters, so their size is fixed; the counts cover all documents.

Defined results: a null text is an empty one; repeated rows each get a result; very long texts and tokens are scanned whole; without any labelled
sample of random strings the method adds nothing; an empty table gives an empty table. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import encoded, map_parts, map_texts, texts_of

# Fixed patterns: (kind, pattern, group that is measured, least length). ASCII only; letters of the names in either case.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no look
_PATTERNS = (("assign", _ASSIGN, 2, 6), ("access", _ACCESS, 0, 20), ("hex", _HEX, 0, 24))
KINDS = ("assign", "access", "hex", "model")

#: Characters of the tokens that the models judge, and the length from which on a token is no sample of ordinary ones: secrets would be among them.
_CLASS = np.zeros(128, np.uint8)
_CLASS[[c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_.=-"]] = 1
SAMPLED = 16
_SLICE = 1 << 20
#: The ratio must be above this for the token as a whole, and above PER_CHAR for each of its characters.
LIMIT = 20.0
PER_CHAR = 0.9
SMOOTHING = 0.5
_BASE = 128
_OUTSIDE = re.compile(r"[^A-Za-z0-9+/_.=-]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, kind by kind: leftmost, non-overlapping, then those too short dropped."""
    return [
        (kind, m.start(), m.end())
        for kind, pattern, group, least in _PATTERNS
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


class Tokens:
    """The tokens of a part of a text: where they begin and end, and the pairs of their characters, with 0 for both ends."""

    def __init__(self, text: str) -> None:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.minimum(points, 127).astype(np.uint8)
        self.inside = _CLASS[low].astype(bool) & (points < 127)
        edge = np.diff(self.inside.astype(np.int8), prepend=0, append=0)
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        codes = np.zeros(len(low) + 2, np.int32)
        codes[1:-1] = np.where(self.inside, low, 0)
        self.pairs = codes[:-1] * _BASE + codes[1:]  # the pair that a character ends, and behind a token that of its end

    def kept(self, which: np.ndarray) -> np.ndarray:
        """Places of all pairs of some tokens."""
        size = self.end[which] - self.begin[which] + 1
        return np.repeat(self.begin[which] - np.cumsum(size) + size, size) + np.arange(size.sum())

    def apart(self, spans: list[tuple[int, int]]) -> np.ndarray:
        """Which tokens have no character in a span."""
        out = np.ones(len(self.begin), bool)
        for a, b in spans:
            out[np.searchsorted(self.end, a, "right") : np.searchsorted(self.begin, b, "left")] = False
        return out


def _parts(text: str) -> Iterator[tuple[int, str]]:
    """Parts of a text of a bounded length with their places; a token that does not end for a whole part more is cut."""
    begin = 0
    while begin < len(text):
        end = begin + _SLICE
        if end < len(text):
            rest = _OUTSIDE.search(text, end, end + _SLICE)
            end = rest.start() if rest else min(len(text), end + _SLICE)
        yield begin, text[begin:end]
        begin = end


def _samples(texts: Iterator[str | None]) -> Iterator[dict[str, list]]:
    """Pairs of characters of the values that the fixed patterns find and of the tokens outside of them."""
    sums = {label: np.zeros(_BASE * _BASE, np.int64) for label in ("random", "ordinary")}

    def add(label: str, found: Tokens, which: np.ndarray) -> None:
        sums[label] += np.bincount(found.pairs[found.kept(which)], minlength=_BASE * _BASE)

    for text in texts:
        spans = []
        for kind, a, b in base_spans(text or ""):
            value = re.split("[:=]", text[a:b], maxsplit=1)[1].lstrip(" \"'") if kind == "assign" else text[a:b]
            found = Tokens(value)
            add("random", found, np.ones(len(found.begin), bool))
            spans.append((a, b))
        for at, part in _parts(text or ""):
            found = Tokens(part)
            add("ordinary", found, found.apart([(a - at, b - at) for a, b in spans]) & (found.end - found.begin < SAMPLED))
    for label, counts in sums.items():
        pairs = np.flatnonzero(counts)
        yield {"label": [label] * len(pairs), "pair": pairs, "n": counts[pairs]}


def train(docs: DataFrame) -> np.ndarray | None:
    """Log-likelihood ratio, random to ordinary, for each pair of characters; None without samples of random strings."""
    parts = map_parts(docs, "text", _samples, {"label": "string", "pair": "int", "n": "long"})
    rows = parts.groupBy("label", "pair").agg(F.sum("n").alias("n")).toPandas()  # at most 2 * 128 * 128 rows
    tables = {}
    for label in ("random", "ordinary"):
        own = rows[rows["label"] == label]
        if own.empty:
            return None
        table = np.zeros(_BASE * _BASE)
        table[own["pair"].to_numpy()] = own["n"].to_numpy()
        table = table.reshape(_BASE, _BASE)
        shares = table.sum(axis=0) + SMOOTHING
        shares /= shares.sum()
        weight = SMOOTHING * _BASE  # an unseen pair backs off to the share of its second byte
        tables[label] = np.log((table + weight * shares) / (table.sum(axis=1, keepdims=True) + weight))
    return (tables["random"] - tables["ordinary"]).astype(np.float32)


def ratio(model: np.ndarray, token: str) -> float:
    """Log-likelihood ratio of a token with its beginning and end."""
    codes = np.minimum(np.frombuffer(b"\0" + encoded(token) + b"\0", np.uint8), _BASE - 1)
    return float(model[codes[:-1], codes[1:]].sum())


def model_spans(text: str, base: list[tuple[str, int, int]], model: np.ndarray | None, limit: float, per_char: float):
    if model is None:
        return []
    out = []
    for at, part in _parts(text):
        found = Tokens(part)
        if not len(found.begin):
            continue
        # sums between the places of tokens; the pairs in between count for nothing
        sums = np.concatenate([[0.0], np.cumsum(model.ravel()[found.pairs], dtype=np.float64)])
        score = sums[found.end + 1] - sums[found.begin]
        high = (score > limit) & (score > per_char * (found.end - found.begin))
        if high.any():
            high &= found.apart([(a - at, b - at) for _, a, b in base])
            out += [("model", int(a) + at, int(b) + at) for a, b in zip(found.begin[high], found.end[high], strict=True)]
    return out


def scan(docs: DataFrame, model: np.ndarray | None, limit: float = LIMIT, per_char: float = PER_CHAR) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_model, base_sha256, spans) of each row of ``docs`` (doc_id, text)."""

    def each(text: str | None) -> tuple:
        text = text or ""
        base = base_spans(text)
        more = model_spans(text, base, model, limit, per_char)
        n = Counter(k for k, _, _ in base)
        return n["assign"], n["access"], n["hex"], len(more), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)

    fields = {"n_assign": "long", "n_access": "long", "n_hex": "long", "n_model": "long", "base_sha256": "string", "spans": "string"}
    return map_texts(docs, ["doc_id"], "text", each, fields)


def redact(docs: DataFrame, model: np.ndarray | None, mask: str = "[secret]", limit: float = LIMIT, per_char: float = PER_CHAR) -> DataFrame:
    """The same rows with each secret replaced in ``text`` and, where there is one, ``n_chars`` set anew; a null text stays."""

    def cleaned(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        spans = sorted((a, b) for _, a, b in base + model_spans(text, base, model, limit, per_char))
        parts, at = [], 0
        for a, b in spans:
            if a >= at:
                parts += [text[at:a], mask]
            at = max(at, b)
        return "".join([*parts, text[at:]]) if spans else text

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array(map(cleaned, texts_of(texts)), pa.string())

    out = docs.withColumn("text", clean.asNondeterministic()(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
