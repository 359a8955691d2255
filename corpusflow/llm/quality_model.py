"""Quality classifier: interpolated modified Kneser-Ney models trained on trusted text.

Texts are judged by the word trigrams of ``word_model``, whose tables grow with the trusted text. Below its unigrams lies a model of spelling, which
is trained here: bytes are mapped to 64 symbols by a fixed rule, so that a model of order 4 has at most 2 ** 24 entries. Its n-grams
are counted in shards by n-gram; continuation counts, discounts and interpolated probabilities of each order are joins and sums over these sharded
tables, and the finished table is sent to the tasks. A document is rejected if its perplexity by byte is above the quantile ``QUANTILE`` of the trusted
documents of its language.

Short texts vary much, so perplexity is that of the text with ``PRIOR`` bytes of average trusted text added.

Defined results: null and empty texts have no perplexity and are rejected, as nothing can be judged; a language without trusted documents rejects
nothing else, and neither does a corpus without any; a null language is a language of its own; a document with several labels is trusted if all say
so; repeated rows each get a result; an empty table gives an empty table. Only doc_id, text and lang are read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import word_model
from corpusflow.llm.common import encoded, map_parts, map_texts, packed, unpacked
from corpusflow.session import settle

ORDER = 4
QUANTILE = 0.998
PRIOR = 100
#: Trusted ids are broadcast up to this number; beyond it, documents and ids are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_BITS, _SYMBOLS = 6, 64
_FLUSH = 1 << 20
_SCALE = 2000  # the table holds negative logarithms in whole steps of 1 / _SCALE, in 16 bits
_LEAST = 1e-12


def _symbols() -> np.ndarray:
    """Symbol of each byte; 0 stands before the text. Letters a-z keep their own, other bytes share one by kind."""
    of = np.full(256, 39, np.uint8)
    of[ord("a") : ord("z") + 1] = np.arange(1, 27)
    of[ord("A") : ord("Z") + 1] = 27
    of[ord("0") : ord("9") + 1] = 28
    for symbol, chars in enumerate((b" \t", b"\n\r", b".", b",", b"'\"", b"-_", b"!?", b"()[]{}", b"#*$%&|<>@^~`+=\\/", b":;"), 29):
        of[list(chars)] = symbol
    of[0x80:0xC0] = 40 + np.arange(64) % 16
    of[0xC0:] = 56 + np.arange(64) % 8
    return of


def grams(text: str | None, of: np.ndarray) -> np.ndarray:
    """For each byte of the text, the number of its n-gram: ORDER symbols of 6 bits, the last one lowest."""
    symbols = np.zeros(len(data := encoded(text)) + ORDER - 1, np.int32)
    symbols[ORDER - 1 :] = of[np.frombuffer(data, np.uint8)]
    n = len(data)
    out = np.zeros(n, np.int32)
    for i in range(ORDER):
        out = (out << _BITS) | symbols[i : i + n]
    return out


def gram_sums(texts: list[str], of: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each text (none is empty) the sum of the values of its n-grams, as ``grams`` gives them; many short texts at once."""
    out, at = np.empty(len(texts), np.int64), 0
    before = bytes(ORDER - 1)
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and size < _FLUSH:
            some.append(before + encoded(texts[at + len(some)]))
            size += len(some[-1])
        ends = np.cumsum([len(t) for t in some])
        starts = np.concatenate([[0], ends[:-1]])
        outside = (starts[:, None] + np.arange(ORDER - 1)).ravel()
        symbols = of[np.frombuffer(b"".join(some), np.uint8)].astype(np.int32)
        symbols[outside] = 0
        ids = np.zeros(size, np.int32)
        for i in range(ORDER):
            ids[ORDER - 1 :] = (ids[ORDER - 1 :] << _BITS) | symbols[i : size - ORDER + 1 + i]
        found = values[ids].astype(np.int64)
        found[outside] = 0
        out[at : at + len(some)] = np.add.reduceat(found, starts)
        at += len(some)
    return out


def count_grams(texts: DataFrame) -> DataFrame:
    """(g, n): the n-grams of all texts, counted in each task and then summed in shards."""
    of = _symbols()

    def counted(rows):
        held, size = [], 0
        for text in rows:
            ids = grams(text, of)
            for begin in range(0, len(ids), _FLUSH):
                held.append(ids[begin : begin + _FLUSH])
                size += len(held[-1])
                if size >= _FLUSH:
                    yield sums(held)
                    held, size = [], 0
        if held:
            yield sums(held)

    def sums(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return {"g": found, "n": n}

    return map_parts(texts, "text", counted, {"g": "int", "n": "long"}).groupBy("g").agg(F.sum("n").alias("n"))


def _discounts(rows: DataFrame) -> list[float]:
    """The three discounts of an order from its counts of counts; where these do not give any, half a count."""
    return _discounts_of(*rows.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first())


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    if not (n1 and n2 and n3):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [d if 0 < d < i else 0.5 * i for i, d in enumerate(found, 1)]


def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 on: (g, p) of the n-grams seen, interpolated, and (c, w), the weight a context gives to the order below."""
    orders = [counts]
    for k in range(ORDER - 1, 0, -1):  # distinct symbols before an n-gram, for all orders but the highest
        low = F.col("g").bitwiseAND(F.lit((1 << _BITS * k) - 1)).alias("g")
        orders.insert(0, settle(orders[0].groupBy(low).agg(F.count("*").alias("n"))))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, rows in enumerate(orders, 1):
        d1, d2, d3 = _discounts(rows)
        context = F.shiftright("g", _BITS)
        weight = (d1 * F.count_if(F.col("n") == 1) + d2 * F.count_if(F.col("n") == 2) + d3 * F.count_if(F.col("n") > 2)) / F.sum("n")
        contexts = rows.groupBy(context.alias("c")).agg(F.sum("n").alias("total"), weight.alias("w"))
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        own = rows.withColumn("c", context).join(contexts, "c")
        if k == 1:
            lower = F.lit(1 / _SYMBOLS)
        else:
            below = out[-1][0].select(F.col("g").alias("_g"), F.col("p").alias("_p"))
            own = own.join(below, F.col("g").bitwiseAND(F.lit((1 << _BITS * (k - 1)) - 1)) == F.col("_g"))
            lower = F.col("_p")
        p = (F.col("n") - cut) / F.col("total") + F.col("w") * lower
        out.append((settle(own.select("g", p.alias("p"))), settle(contexts.select("c", "w"))))
    return out


def costs(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Negative logarithm of the probability of each of the 2 ** 24 n-grams, seen or not, in steps of 1 / _SCALE."""
    lower = np.full(1, 1 / _SYMBOLS)
    out = np.empty(_SYMBOLS**ORDER, np.uint16)
    for k, (g, p, c, w) in enumerate(parts, 1):
        weights = np.ones(_SYMBOLS ** (k - 1))  # an unseen context leaves all to the order below
        weights[c] = w
        order = np.argsort(g)
        g, p = g[order], p[order]
        rows = []
        for a in range(_SYMBOLS if k > 1 else 1):  # n-grams that begin with the same symbol
            # p(d | a b c) of n-grams not seen: weight(a b c) * p(d | b c)
            dense = weights * lower[0] if k == 1 else (weights.reshape(_SYMBOLS, -1)[a][:, None] * lower.reshape(-1, _SYMBOLS)).ravel()
            if k == 1:
                dense = np.full(_SYMBOLS, dense[0])
            begin, size = a * len(dense), len(dense)
            i, j = np.searchsorted(g, [begin, begin + size])
            dense[g[i:j] - begin] = p[i:j]
            if k < ORDER:
                rows.append(dense)
            else:
                out[begin : begin + size] = np.rint(-np.log(np.maximum(dense, _LEAST)) * _SCALE)
        lower = np.concatenate(rows) if rows else lower
    return out


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    ids = settle(trusted)
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(side, "doc_id", "left_semi")


def train(docs: DataFrame, trusted: DataFrame) -> list[tuple] | None:
    """The model as arrays (n-grams, probabilities, contexts, weights) of each order; at most 2 ** 24 n-grams. None without trusted text."""
    counts = settle(count_grams(trusted_texts(docs.select("doc_id", "text"), trusted).select("text")))
    if counts.isEmpty():
        return None
    model = []
    for probabilities, contexts in kneser_ney(counts):
        p, c = probabilities.toPandas(), contexts.toPandas()
        model.append((
            p["g"].to_numpy(np.int32), p["p"].to_numpy(np.float32), c["c"].to_numpy(np.int32), c["w"].to_numpy(np.float32),
        ))
    return model


def _table(held: dict) -> np.ndarray:
    """The costs of a model that was sent; they are filled once in each process that reads them."""
    if "costs" not in held:
        held["costs"] = costs(held["model"])
    return held["costs"]


def _scorer(spark, model: list[tuple] | None):
    """A function of a text that gives (symbols, sum of negative logarithms), and one that gives the sums of many texts, none of them empty."""
    sent, of = spark.sparkContext.broadcast({"model": model}), _symbols()

    def score(text: str | None) -> tuple[int, float]:
        if not text or sent.value["model"] is None:
            return len(encoded(text)), 0.0
        ids = grams(text, of)
        return len(ids), int(_table(sent.value)[ids].sum(dtype=np.int64)) / _SCALE

    def several(texts: list[str]) -> np.ndarray:
        if not texts or sent.value["model"] is None:
            return np.zeros(len(texts))
        return gram_sums(texts, of, _table(sent.value)) / _SCALE

    return score, several


def _stratum() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def _smoothed(mean: float) -> Column:
    return (F.col("nll") + F.lit(mean * PRIOR)) / (F.col("n") + F.lit(PRIOR))


def thresholds(scores: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> tuple[float, DataFrame]:
    """Mean of trusted text, and (_stratum, threshold) of the scores (doc_id, stratum, n, nll) of the trusted documents."""
    known = settle(scores.join(trusted, "doc_id", "left_semi").filter("n > 0"))
    total, n = known.agg(F.sum("nll"), F.sum("n")).first()
    mean = total / n if n else 0.0
    limit = F.percentile_approx(_smoothed(mean), F.lit(quantile), F.lit(100_000))
    return mean, settle(known.groupBy(F.col("stratum").alias("_stratum")).agg(limit.alias("threshold")))


def scored(docs: DataFrame, model) -> DataFrame:
    marked = docs.select("doc_id", _stratum().alias("stratum"), "text")
    return settle(map_texts(marked, ["doc_id", "stratum"], "text", _scorer(docs.sparkSession, model)[0], {"n": "long", "nll": "double"}))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that all labels (doc_id, good) call good."""
    return labels.filter("good is not null and doc_id is not null").groupBy("doc_id").agg(F.min("good").alias("good")).filter("good = 1").select("doc_id")


def judged(docs: DataFrame, labels: DataFrame, quantile: float) -> tuple[float, DataFrame]:
    """Mean of trusted text, and the scores (doc_id, stratum, who, more, n, nll) of each row with the threshold of its stratum."""
    trusted = settle(trusted_ids(labels))
    symbols = train(docs, trusted)
    score, several = _scorer(docs.sparkSession, symbols)

    def coder() -> word_model.Coder:
        return word_model.Coder(lambda text: score(text)[1], several)

    ids = trusted.select(F.col("doc_id").alias("_id"))
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    flag = F.col("_id").isNotNull().alias("trusted")
    marked = docs.select("doc_id", "text", word_model.half(F.col("doc_id")).alias("half"), *identity()).join(side, F.col("doc_id") == F.col("_id"), "left")
    found = word_model.scored(marked.select("who", "more", "half", flag, "text"), coder, _discounts_of)
    rows = docs.select("doc_id", _stratum().alias("stratum"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n"), *identity())
    scores = settle(rows.join(found, ["who", "more"]))
    mean, limits = thresholds(scores, trusted, quantile)
    return mean, scores.join(limits, F.col("stratum") == F.col("_stratum"), "left")


def identity() -> list[Column]:
    """A row by its contents, in 128 bits: rows that are equal in them get equal results."""
    return [F.xxhash64(F.lit(i), "doc_id", _stratum(), "text").alias(n) for i, n in enumerate(("who", "more"))]


def _kept(mean: float) -> Column:
    return F.coalesce((F.col("n") > 0) & (_smoothed(mean) <= F.coalesce("threshold", F.lit(math.inf))), F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, n_symbols, perplexity, threshold, kept) of each row of ``docs``; ``labels`` has (doc_id, good)."""
    mean, out = judged(docs, labels, quantile)
    mean_nll = F.when(F.col("n") > 0, _smoothed(mean))
    return out.select("doc_id", F.col("n").alias("n_symbols"), F.exp(mean_nll).alias("perplexity"), F.exp("threshold").alias("threshold"), _kept(mean).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps."""
    mean, rows = judged(docs, labels, quantile)
    gone = settle(rows.filter(~_kept(mean)).select(F.col("who").alias("_who"), F.col("more").alias("_more")).distinct())
    who, more = identity()
    same = (F.col("who") == F.col("_who")) & (F.col("more") == F.col("_more"))
    return packed(docs, who=who, more=more).join(gone, same, "left_anti").select(*unpacked(docs.columns))
