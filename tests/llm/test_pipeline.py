"""The stages of the pipeline on the smallest documents, each against a plain version of its rule."""

import os

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import toxicity
from test_operators import FOLDER, components, shingle_set, words

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def documents(spark):
    """The documents with odd rows, and with columns whose names the stages use themselves."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (90_001, "", "en", "s", 0), (90_002, None, "en", "s", None), (90_003, "12 34 !?", None, "s", 8),
         (90_004, "word " * 20_000, "en", "s", 100_000), (0, "another text under the same id as a document", "en", "s", 1), (90_005, "Short one", "xx", "s", 9), (90_005, "Short one", "xx", "s", 9)],
        "doc_id long, text string, lang string, source string, n_chars long")
    return docs.unionByName(odd).withColumn("score", F.lit("own")).withColumn("cls", F.lit(1)).withColumn("kept", F.lit("own"))


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "minhash_near_dedup", "decontamination", "sentencepiece"]


def test_toxicity_keeps_what_is_clean(spark, documents):
    kept = STAGES["toxicity"](spark, documents, FOLDER)
    assert kept.columns == documents.columns and {r.score for r in kept.select("score").collect()} == {"own"}
    gone = documents.join(kept.select("doc_id").distinct(), "doc_id", "left_anti").where("doc_id is not null")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    removed = [labels[r.doc_id] for r in gone.collect() if r.doc_id in labels]
    assert sum(removed) >= 0.7 * len(removed) and not {90_001, 90_002} & {r.doc_id for r in gone.collect()}


def test_languages_without_letters_go(spark, documents):
    kept = STAGES["language_id"](spark, documents, FOLDER)
    assert kept.columns == documents.columns
    want = [r for r in documents.collect() if any(c.isalpha() for c in r.text or "")]
    assert ids(kept) == sorted((r.doc_id is None, r.doc_id or 0) for r in want)


def test_one_of_each_group_stays(spark, documents):
    rows = documents.collect()
    names = {k: (r.doc_id if r.doc_id is not None else 10**9) for k, r in enumerate(rows)}
    group = components({k: shingle_set(r.text, 5) for k, r in enumerate(rows)}, 80)
    lowest = {}
    for k, g in group.items():
        lowest[g] = min(lowest.get(g, 10**10), names[k])
    want = {(rows[k].doc_id, rows[k].text) for k in group if names[k] == lowest[group[k]] or not words(rows[k].text)}
    kept = STAGES["minhash_near_dedup"](spark, documents, FOLDER)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == documents.columns and len(got) == len(set(got)) and set(got) == want


def test_benchmark_passages_go(spark, documents):
    import re

    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    windows = set()
    for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall():
        w = plain(t)
        windows |= {tuple(w[k:k + 8]) for k in range(len(w) - 7)}
    bad = {r.doc_id for r in documents.collect() if any(tuple(plain(r.text)[k:k + 8]) in windows for k in range(len(plain(r.text)) - 7))}
    kept = STAGES["decontamination"](spark, documents, FOLDER)
    assert kept.columns == documents.columns
    assert ids(kept) == sorted((r.doc_id is None, r.doc_id or 0) for r in documents.collect() if r.doc_id not in bad)


def test_the_whole_run(spark):
    import sentencepiece

    out = corpus_pipeline.run(spark, FOLDER)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = out.collect()
    assert 0 < len(rows) < len(texts)
    assert all(list(r.ids) == library.encode(texts[r.doc_id]) and r.round_trip for r in rows)


def test_stages_of_nothing(spark, documents):
    docs = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, FOLDER)
        assert docs_out.collect() == [], name


def test_thresholds_fall_back_to_the_usual_one(spark):
    row = spark.range(1).select(F.lit("xx").alias("lang")).select(toxicity.threshold(toxicity.Constant(0.0, {"en": 0.5})).alias("t")).first()
    assert row.t == toxicity.THRESHOLD
