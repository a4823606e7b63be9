"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sievework.llm import norm_search

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, rank string"
DOCS = "doc_id long, text string, score string, n int"


def terms(text):
    return TERM.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))


def expected(docs, items):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        rows = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(rows)[:10])]
    return sorted(out, key=repr)


def found(spark, docs, items):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS)
    items = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in norm_search.search(docs, items).collect()), key=repr)


def test_terms():
    texts = ["Don't STOP—ÀÉ 12_x\x00y\x7fz\t日本", "", None, "  "]
    words = norm_search.terms_of(pa.array(texts))
    got = [[words.vocabulary[int(c)].as_py() for c in words.codes[a:b]] for a, b in zip(words.bounds, words.bounds[1:])]
    assert got == [terms(t) for t in texts]


def test_search_equals_all_scores(spark):
    docs, items = (duckdb.sql(f"SELECT {key}, text FROM '{FOLDER}/{name}.parquet'").fetchall() for key, name in (("doc_id", "documents"), ("item_id", "benchmark")))
    assert found(spark, docs, items) == expected(docs, items)


@pytest.mark.parametrize("seed", range(2))
def test_small_buckets_and_blocks(spark, monkeypatch, seed):
    """Many buckets, few groups and several blocks of items: bounds prune, results stay the same."""
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(k, text(rng.randrange(1, 60))) for k in range(500)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)]                     # ties
    items = [(k, text(rng.randrange(1, 8))) for k in range(30)]
    monkeypatch.setattr(norm_search, "ITEMS", 12)
    assert found(spark, docs, items) == expected(docs, items)


def test_pruning_keeps_the_best():
    """One task over buckets of 16 with 8 groups of coordinates, against the whole product."""
    rng = np.random.default_rng(1)
    n, n_terms = 400, 60
    counts = rng.poisson(0.3, (n, n_terms))
    lists = [np.flatnonzero(row) for row in counts]
    size = counts.sum(1) + 1
    weights = rng.integers(0, 9000, n_terms)
    asked = [np.sort(rng.choice(n_terms, rng.integers(1, 9), replace=False)) for _ in range(12)]
    held = norm_search.Collection(list(range(12)), np.concatenate(asked), np.append(0, np.cumsum([len(a) for a in asked])), weights, n, int(size.sum()))
    class Holder:
        def __init__(self, value):
            self.value = value
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(size), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32())),
         pa.array([counts[i][x].astype(np.int32) for i, x in enumerate(lists)], pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tf"])
    batch = next(norm_search.norms([batch], Holder(held)))
    batch = batch.take(pa.array(np.argsort(-batch.column("norm").to_numpy())))
    kept = norm_search.BUCKET, norm_search.GROUPS
    norm_search.BUCKET, norm_search.GROUPS = 16, 8
    try:
        out = pa.Table.from_batches(list(norm_search.searched([batch], Holder(held), Holder(np.zeros(12, np.int64))))).to_pylist()
    finally:
        norm_search.BUCKET, norm_search.GROUPS = kept
    m = 10 + 90 * size * n // int(size.sum())
    x = weights * (10 ** 9 * counts // (1000 * counts + 8 * m[:, None]))
    for k, own in enumerate(asked):
        scores = x[:, own].sum(1)
        want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if s > 0))[:10]
        assert [(-r["score"], r["doc_id"]) for r in out if r["item"] == k] == want


def test_odd_rows(spark):
    docs = [(None, None), (None, "a b c"), (1, ""), (2, "... !!"), (3, "A b"), (3, "A b"), (4, "word " * 40_000), (5, "日本語 é"), (6, "a b c d")]
    items = [(None, "a"), (1, "b c"), (1, "d"), (2, None), (3, ""), (4, "word É é 日本語"), (5, "nowhere"), (5, "nowhere")]
    assert found(spark, docs, items) == expected(docs, items)
    assert found(spark, docs[:0], items) == [] and found(spark, docs, items[:0]) == [] and found(spark, docs[:1], items) == []
