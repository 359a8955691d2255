"""Token counts by a count-only Viterbi search.

A unigram tokenizer cuts a text into pieces of its vocabulary so that the sum of their scores is greatest. Here an Aho-Corasick automaton lists all
pieces that end at each character; the search keeps the best score and the number of tokens up to each character, and no path. Ties go as in
the tokenizer: a later candidate replaces an earlier one only if its score is greater, and candidates come in the order of their start, so
the longest piece wins. A character without a piece of its own costs the least score less 10 and counts as one token or, with byte pieces, as one
for each of its UTF-8 bytes.

Spaces are written as the mark U+2581 and one is put in front. As no piece has the mark behind another character, a text falls into independent
parts at each run of marks; the counts of parts seen lately are kept in a table of bounded size.

Defined results: null and empty texts have no tokens; repeated rows each get a result; very long texts and words are counted whole; an
empty table gives an empty table. Only doc_id and text are read. Scores are summed as 64-bit numbers, exact for vocabularies with whole scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from corpusflow.llm.common import encoded, map_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT = 300_000  # parts whose counts a task keeps
_PARTS = re.compile(f"{MARK}+[^{MARK}]*|^[^{MARK}]+")


@dataclass
class Vocabulary:
    """Pieces with scores; ``bytes_for_unknown`` if there is a piece for each byte."""

    pieces: list[tuple[str, float]]
    least: float
    bytes_for_unknown: bool


def read_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a SentencePiece file, with their scores; the file is read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids if not special[i]]
    return Vocabulary(pieces, min(s for _, s in pieces), any(model.is_byte(i) for i in ids))


class Counter:
    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.unknown = vocabulary.least - UNKNOWN_PENALTY
        self.bytes_for_unknown = vocabulary.bytes_for_unknown
        self.splits = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary.pieces)
        self.known: dict[str, int] = {}
        self.kept = kept

    def search(self, part: str) -> int:
        best, tokens = [0.0] * (len(part) + 1), [0] * (len(part) + 1)
        at, found = 0, True  # the end that matches are gathered for, and whether it has one

        def leave() -> None:
            """The candidate of one unknown character starts last, so it comes after all matches of its end."""
            if at and part[at - 1] not in self.single:
                score = best[at - 1] + self.unknown
                if not found or score > best[at]:
                    best[at] = score
                    tokens[at] = tokens[at - 1] + (len(encoded(part[at - 1])) if self.bytes_for_unknown else 1)

        for last, (length, score) in self.automaton.iter(part):  # by end, and for each end the longest first
            while at <= last:
                leave()
                at, found = at + 1, False
            total = best[at - length] + score
            if not found or total > best[at]:
                best[at], tokens[at], found = total, tokens[at - length] + 1, True
        leave()
        while at < len(part):
            at, found = at + 1, False
            leave()
        return tokens[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.search(marked)
        known, total = self.known, 0
        for part in _PARTS.findall(marked):
            n = known.get(part)
            if n is None:
                n = self.search(part)
                if len(part) <= 64:
                    if len(known) >= self.kept:
                        known.clear()
                    known[part] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens) of each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.least, vocabulary.bytes_for_unknown))
    made: list[Counter] = []  # one in each task

    def each(text: str | None) -> tuple:
        if not made:
            made.append(Counter(Vocabulary(*sent.value)))
        return (made[0].count(text),)

    return map_texts(docs, ["doc_id"], "text", each, {"n_tokens": "long"})
