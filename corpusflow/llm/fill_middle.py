"""Fill-in-the-middle transformation with a learned rank index over token boundaries.

A text is cut into tokens: runs of ASCII letters, and every other character by itself. Two ranks among the boundaries between tokens cut it into
prefix, middle and suffix, which are put together with markers in one of two orders.

The cuts come from a learned index. All boundary offsets of a text, as a function of their rank, are covered greedily with straight pieces: a piece
goes on while some line through its first boundary stays within ``error`` characters of every boundary of it. An offset is predicted by the line of
its piece, and the stored difference between boundary and prediction, one byte for each, corrects it exactly. Texts are read in slices of
``SLICE`` characters, so beside the text only the pieces and one byte for each token are held, whatever its length.

Defined results: a null text is empty, and an empty text is plain with no tokens; a text that holds a marker is plain, since it could not be taken
apart again; a null id is hashed as no digits; repeated rows give equal results; an empty table gives an empty table. Only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100 texts, those from here on stay plain
SPM_BELOW = 20  # of 100 others, those below have the suffix first
SEED = 1
ERROR = 64
SLICE = 1 << 20
_STEP = 512
_HELD = 4 << 20  # characters of output in one batch


def boundaries(text: str, begin: int, end: int) -> np.ndarray:
    """Offsets in [begin, end) at which a token begins."""
    before = begin and "A" <= text[begin - 1].upper() <= "Z" and text[begin - 1].isascii()
    points = np.frombuffer(text[begin:end].encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - np.uint32(97)) < 26
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] &= bool(before)
    return np.flatnonzero(~inside) + begin


def pieces(offsets: np.ndarray, error: int) -> tuple[list[int], list[float]]:
    """First rank and slope of the straight pieces that cover increasing offsets within ``error``."""
    firsts, slopes, first, n = [], [], 0, len(offsets)
    while first < n:
        low, high, at, step = -np.inf, np.inf, first + 1, _STEP
        while at < n:  # the cone of lines through the first boundary, narrowed by steps that grow
            end = min(n, at + step)
            run = np.arange(at - first, end - first)
            rise = offsets[at:end] - offsets[first]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            crossed = lows > highs
            stop = int(crossed.argmax()) if crossed[-1] else end - at
            if stop:
                low, high = lows[stop - 1], highs[stop - 1]
            at += stop
            if crossed[-1]:
                break
            step *= 2
        firsts.append(first)
        slopes.append((low + high) / 2 if at > first + 1 else 0.0)
        first = at
    return firsts, slopes


class RankIndex:
    """The offset of every token boundary of a text by its rank; the last rank is the end of the text."""

    def __init__(self, text: str, error: int = ERROR) -> None:
        assert 0 < error < 127
        parts: list[tuple[np.ndarray, ...]] = []
        ranks = 0
        for begin in range(0, len(text) + 1, SLICE):
            end = begin + SLICE
            offsets = boundaries(text, begin, end) if begin < len(text) else np.empty(0, np.int64)
            if end > len(text):
                offsets = np.append(offsets, len(text))
            if not len(offsets):
                continue
            firsts, slopes = pieces(offsets, error)
            first, slope = np.array(firsts), np.array(slopes)
            run = np.diff(first, append=len(offsets))
            guess = np.repeat(offsets[first], run) + np.floor(np.repeat(slope, run) * (np.arange(len(offsets)) - np.repeat(first, run))).astype(np.int64)
            parts.append((first + ranks, offsets[first], slope, (offsets - guess).astype(np.int8)))
            ranks += len(offsets)
        self.first, self.base, self.slope, self.rest = (np.concatenate(p) for p in zip(*parts, strict=True))
        self.n_tokens = ranks - 1

    def offset(self, rank: int) -> int:
        piece = int(np.searchsorted(self.first, rank, "right")) - 1
        guess = int(self.base[piece]) + int(np.floor(self.slope[piece] * (rank - int(self.first[piece]))))
        return guess + int(self.rest[rank])


def draws(doc_id: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearranged(doc_id: object, text: str | None, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> tuple:
    """(number of tokens, form, characters of the prefix, of the middle, output) of one text."""
    text = text or ""
    index = RankIndex(text)
    n, (h1, h2, h3, h4) = index.n_tokens, draws(doc_id, seed)
    if not text or h3 % 100 >= plain_from or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = sorted((index.offset(h1 % (n + 1)), index.offset(h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size, begin = batch.column("doc_id"), [], 0, 0
            for i, text in enumerate(texts_of(batch.column("text"))):
                held.append(rearranged(ids[i].as_py(), text, seed, plain_from, spm_below))
                size += len(held[-1][-1])
                if size >= _HELD or i == len(batch) - 1:
                    made = [pa.array(list(v), type=t) for v, t in zip(zip(*held, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.slice(begin, len(held)), *made], names)
                    held, size, begin = [], 0, i + 1
        pa.default_memory_pool().release_unused()

    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(mapped, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of; it needs nothing else than the form."""

    def after(text: Column, mark: str) -> Column:
        """What follows the first ``mark``, which a text that was rearranged does not hold itself."""
        return F.substring(text, F.length(F.substring_index(text, mark, 1)) + len(mark) + 1, F.length(text))

    def between(first: str, second: str) -> Column:
        return F.substring_index(after(output, first), second, 1)

    psm = F.concat(between(PREFIX, SUFFIX), after(output, MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(output, MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
