"""The operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.llm import (
    bpe,
    dedup,
    jaccard,
    mixing,
    notices,
    packing,
    pitman_yor,
    pivots,
    pseudonyms,
    quality,
    spelling,
    toxicity,
    whitening,
)
from orestrata.llm.session import prepared

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, index).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id"), 5).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "nearest",
        "cosines",
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    ids = bpe.encode(_table(spark, sf_dir, "documents"), path)
    return bpe.decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = packing.write(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return packing.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host, and its language there its path."""
    docs = _table(spark, sf_dir, "documents")
    classifier = quality.fit(docs, _table(spark, sf_dir, "labels"))
    path = F.concat_ws("/", "source", "lang")
    return quality.score(docs, classifier, F.col("source"), path)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return jaccard.jaccard_components(docs, size=3, num=90, den=100)


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pitman_yor.score(docs, *pitman_yor.fit(docs))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op11_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.scan(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(prepared(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_bpe": op2_bpe,
        "op3_pseudonyms": op3_pseudonyms,
        "op4_pivots": op4_pivots,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_packing": op6_packing,
        "op7_quality": op7_quality,
        "op8_ngram_jaccard": op8_ngram_jaccard,
        "op9_pitman_yor": op9_pitman_yor,
        "op10_mixing": op10_mixing,
        "op11_notices": op11_notices,
        "op12_spelling": op12_spelling,
        "op13_whitening": op13_whitening,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": r"""
            WITH n AS (
              SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
              FROM documents
            )
            SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = min(doc_id) OVER g AS kept, text_sha256
            FROM n WINDOW g AS (PARTITION BY text_sha256)
        """,
        "op10_mixing": mixing.oracle(),
    }
