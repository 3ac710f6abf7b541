"""Training data from raw documents: every stage is one operator, written and read again.

Each stage works on all rows its predecessor kept, and all but the last return the columns of
``documents``, extra ones and those named like a helper included. Rows with nulls and empty texts pass like others; of
equal rows one stays, of ties the least id; texts of any length are read whole; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orestrata.llm import bpe, dedup, jaccard, mixing, toxicity
from orestrata.llm.session import prepared
from orestrata.sources.shared import settle

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepared(spark)
    return dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8."""
    prepared(spark)
    return jaccard.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at equal weights, replicated and shuffled."""
    prepared(spark)
    return mixing.mixture(docs).drop(*mixing.result_names(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the decoded text."""
    prepared(spark)
    path = public_tokenizers.path(VOCABULARY)
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return decoded.select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Scores, links and token ids are beyond SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
