"""The registered queries of the operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import decontaminate, langid, licenses, ngram_lm, norm_search, pivot_index, sentencepiece_fst, token_align, token_counts, toxicity, warc, winnowing
from sievework.llm.common import in_fold, table
from sievework.llm.minhash import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learn = ~in_fold(F.col("doc_id"), 4, 2)
    net = toxicity.fit(documents.where(learn), table(spark, folder, "labels"))
    rows = toxicity.score(documents.withColumn("held_out", ~learn), net)
    return rows.select(
        "doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.threshold(net)).alias("rejected"))


@query("op6_ngram_lm")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 10, 0)
    model = ngram_lm.fit(documents.where(~held_out))
    return ngram_lm.score(documents.select("doc_id", held_out.alias("held_out"), "text"), model)


@query("op8_warc")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    archives, index = warc.write_archives(table(spark, folder, "pages"))
    records = warc.read_records(archives, index, bodies=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    prototypes = langid.fit(documents.where(~held_out))
    return langid.identify(documents.select("doc_id", "text", held_out.alias("held_out")), prototypes)


@query("op3_sentencepiece")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_fst.encode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model"))


@query("op4_token_counts")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


@query("op5_license_rules", licenses.oracle())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op9_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_pivot_index")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.linked_vectors(table(spark, folder, "embeddings"))


@query("op13_winnowing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.digests(table(spark, folder, "documents"))


@query("op11_norm_search", norm_search.oracle())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return norm_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_token_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return token_align.alignments(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
