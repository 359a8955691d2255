import os
import random

import pytest

from corpusflow.llm import token_count
from tests.llm.cases import documents, odd_rows

PATH = os.environ.get("TEST_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
MARK = token_count.MARK


def plain(text, vocabulary):
    """Viterbi over all starts and lengths, replacing only by what is greater."""
    if not text:
        return 0
    pieces, longest = dict(vocabulary.pieces), max(len(p) for p, _ in vocabulary.pieces)
    text = MARK + text.replace(" ", MARK)
    best, n = [0.0] + [None] * len(text), [0] * (len(text) + 1)
    for a in range(len(text)):
        for b in range(a + 1, min(a + longest, len(text)) + 1):
            score = pieces.get(text[a:b])
            if score is not None and (best[b] is None or best[a] + score > best[b]):
                best[b], n[b] = best[a] + score, n[a] + 1
        if text[a] not in pieces and (best[a + 1] is None or best[a] + vocabulary.least - 10 > best[a + 1]):
            best[a + 1] = best[a] + vocabulary.least - 10
            n[a + 1] = n[a] + (len(text[a].encode()) if vocabulary.bytes_for_unknown else 1)
    return n[-1]


@pytest.mark.parametrize("crossing", [False, True])
def test_small_vocabularies_with_ties(crossing):
    rnd = random.Random(1)
    for _ in range(30):
        names = {"".join(rnd.choice("ab" + MARK) for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        names = {p if crossing else MARK * (p.count(MARK) > 0) + p.replace(MARK, "") for p in names} - {""}
        vocabulary = token_count.Vocabulary([(p, -float(rnd.randint(1, 4))) for p in sorted(names)], -4.0, rnd.random() < 0.5)
        counter = token_count.Counter(vocabulary, kept=3)
        for _ in range(40):
            text = "".join(rnd.choice("aabb cé" + MARK) for _ in range(rnd.randint(0, 25)))
            assert counter.count(text) == plain(text, vocabulary), (names, text)


def test_as_the_tokenizer_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_count.read_vocabulary(PATH)
    pieces = [("\x01", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)], *vocabulary.pieces]
    tokenizer = Tokenizer(models.Unigram(pieces, 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(docs, vocabulary).collect()}
    for r in docs.collect():
        assert found[r["doc_id"]] == len(tokenizer.encode(r["text"]).ids)


def test_odd_rows_and_no_rows(spark):
    vocabulary = token_count.read_vocabulary(PATH)
    rows = token_count.token_counts(documents(spark, odd_rows()), vocabulary).collect()
    counter = token_count.Counter(vocabulary)
    assert sorted(r["n_tokens"] for r in rows) == sorted(counter.count(r[1]) for r in odd_rows())
    assert counter.count("x" * 50_000) == plain("x" * 50_000, vocabulary)
    assert token_count.token_counts(documents(spark, []), vocabulary).count() == 0
