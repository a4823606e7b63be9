"""From documents to token ids: toxicity, language, near duplicates, benchmark passages, encoding.

Each stage works on all that the stage before has kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import decontaminate, langid, minhash, sentencepiece_fst, toxicity
from sievework.llm.common import in_fold, stored, table

SHINGLE, PERCENT = 5, 80
ENCODER = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold of their language."""
    learn = docs.where(~in_fold(F.col("doc_id"), 4, 2))
    net = toxicity.fit(learn, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.withColumnRenamed("score", "own_score"), net, keep_text=True)
    kept = scored.where(F.col("score") < toxicity.threshold(net)).drop("score")
    return kept.withColumnRenamed("own_score", "score").select(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know: with letters, and a cosine above zero."""
    prototypes = langid.fit(docs.where(~in_fold(F.col("doc_id"), 5, 0)))
    own = {"lang_pred": "own_lang_pred", "score": "own_score"}
    named = langid.identify(docs.withColumnsRenamed(own), prototypes, keep_text=True)
    kept = named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") > 0)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return minhash.without_near_duplicates(docs, SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = found.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents."""
    return sentencepiece_fst.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(ENCODER))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: No stage but the fourth can be put in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
