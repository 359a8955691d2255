"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the one- to three-grams of a text's lower-cased characters, hashed into ``BUCKETS`` places; document frequencies cover all documents to
learn from. The regression is fitted on at most ``FIT`` of these documents in all, spread evenly over the languages and chosen by a hash of
doc_id and text among the distinct texts of each language, by follow-the-regularised-leader with an elastic net, which leaves most weights at zero. A temperature, fitted on at most ``CALIBRATE`` other
documents, turns scores into calibrated probabilities.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything if there is nothing to learn from; ties go to
the first language in order of code points; documents with a null doc_id are not held out; repeated rows each get a result; an empty table gives an
empty table. Only doc_id, text and lang are read, and lang only to learn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import map_parts, map_texts
from corpusflow.session import settle

BUCKETS = 1 << 15
FIT, CALIBRATE = 3200, 800
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.001
UNKNOWN = "und"
_MULTIPLIERS = ((0x9E3779B97F4A7C15,), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def gram_counts(text: str | None) -> np.ndarray:
    """Occurrences of the n-grams of a whole text, by place."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    for size, factors in enumerate(_MULTIPLIERS, 1):
        n = len(codes) - size + 1
        if n > 0:
            key = sum(codes[i : i + n] * np.uint64(f) for i, f in enumerate(factors))
            key ^= key >> np.uint64(29)
            counts += np.bincount(((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


def weighed(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and TF-IDF values of length one, with a last place that is always on."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((values**2).sum()) or 1.0
    return np.append(at, BUCKETS), np.append(values / norm, 1.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (place, class) of follow-the-regularised-leader, one example at a time in a fixed order."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(42)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            w = weights(z[at], n[at])
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g**2
    return weights(z, n).astype(np.float32)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Least negative log-likelihood over a grid of temperatures."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame) -> dict | None:
    """{langs, idf, weights, temperature} from the documents that are not held out and have a language; None without any."""
    learn = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))

    def frequencies(texts):
        df = np.zeros(BUCKETS, np.int64)
        n = 0
        for text in texts:
            df += gram_counts(text) > 0
            n += 1
        at = np.flatnonzero(df)
        yield {"place": np.append(at, -1), "n": np.append(df[at], n)}

    parts = map_parts(learn, "text", frequencies, {"place": "int", "n": "long"})
    df = {r["place"]: r["n"] for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect()}  # one row per place
    total = df.pop(-1, 0)
    if not total:
        return None
    idf = np.full(BUCKETS, np.log(1 + total))
    idf[list(df)] = np.log((1 + total) / (1 + np.array(list(df.values())))) + 1e-3

    # each text once in its language, then the least chances in two bounded steps: at most FIT + CALIBRATE rows ever come to the driver
    known = [F.xxhash64("text").alias("_hash"), F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("_chance")]
    distinct = settle(learn.select("lang", *known).groupBy("lang", "_hash").agg(F.min("_chance").alias("_chance")))
    langs = settle(distinct.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(FIT).select("lang"))
    per_lang = max(1, (FIT + CALIBRATE) // max(1, langs.count()))
    least = distinct.join(F.broadcast(langs), "lang").withColumn("_part", F.pmod("_hash", F.lit(64)))
    for keys in (["lang", "_part"], ["lang"]):
        least = least.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy("_chance", "_hash"))).filter(F.col("_at") <= per_lang)
    taken = settle(least.select(F.col("lang").alias("_l"), F.col("_hash").alias("_h"), F.col("_chance").alias("_c")))
    here = (F.col("lang") == F.col("_l")) & (F.col("_hash") == F.col("_h")) & (F.col("_chance") == F.col("_c"))
    repeated = learn.select("lang", "text", *known).join(F.broadcast(taken), here).select("lang", "text", "_hash", "_chance")

    def once(batches):
        seen = set()  # at most as many as are taken
        for batch in batches:
            new = []
            for key in zip(*(batch.column(k).to_pylist() for k in ("lang", "_hash")), strict=True):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    chosen = repeated.mapInArrow(once, repeated.schema).groupBy("lang", "_hash", "_chance").agg(F.first("text").alias("text"))

    def sparse(text):
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        return at.astype(np.int32).tobytes(), counts[at].astype(np.int32).tobytes()

    rows = map_texts(chosen, ["lang", "_chance"], "text", sparse, {"at": "binary", "counts": "binary"}).collect()
    langs = sorted({r["lang"] for r in rows})
    seen = dict.fromkeys(langs, 0)
    fitted, calibrated = [], []
    for r in sorted(rows, key=lambda r: (r["_chance"], r["lang"], r["at"], r["counts"])):
        seen[r["lang"]] += 1
        if seen[r["lang"]] > per_lang:
            continue
        counts = np.zeros(BUCKETS, np.int64)
        counts[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["counts"], np.int32)
        example = (*weighed(counts, idf), langs.index(r["lang"]))
        (calibrated if seen[r["lang"]] % 5 == 0 else fitted).append(example)
    if not fitted:
        return None
    weights = fit(fitted, len(langs))
    held = calibrated or fitted
    t = temperature(np.array([x @ weights[at] for at, x, _ in held]), np.array([y for _, _, y in held]))
    return {"langs": langs, "idf": idf.astype(np.float32), "weights": weights, "temperature": t}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of ``docs``, from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS times the number of languages

    def each(text: str | None) -> tuple:
        m = sent.value
        if not m or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        at, x = weighed(gram_counts(text), m["idf"])
        p = softmax(x @ m["weights"][at] / m["temperature"])
        best = int(np.argmax(p))
        return m["langs"][best], float(min(1.0, p[best]))

    found = map_texts(docs, ["doc_id"], "text", each, {"lang_pred": "string", "score": "double"})
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
