"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

1. The quality classifier is trained on documents labelled good; documents that it rejects go.
2. Of each group of near duplicates (fingerprints over four-word shingles, linked at four or fewer differing bits) the document with the smallest id stays.
3. Documents that hold a passage of ``benchmark`` go.
4. Secrets are replaced by a mask in the text.
5. Sources are mixed to their target weights; the result has the documents taken and how often each is taken, as ``copies``.

Defined results: null and empty texts go in the first stage, which cannot judge them; a null id comes last when one of a group is kept, and a null
language or source is one of its own; of equal rows the near-duplicate stage keeps one; long texts are read whole by every stage; ties follow the stages; empty tables
give an empty table; columns beside those of documents stay as they are, but a column ``copies`` gives way to that of the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, mixing, quality_model, secret_scan, simhash
from corpusflow.llm.common import table
from corpusflow.session import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    return quality_model.good_documents(docs, labels)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, secret_scan.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: No SQL can express the trained models of the first and fourth stage; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
