"""Fingerprints against a plain walk over every window."""

import hashlib
import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from sievework.llm import winnowing

FOLDER = "/root/testdata/sf0.001"


def hash64(text, code="utf-8"):
    x = xxhash.xxh64_intdigest(text.encode(code), seed=42)
    return x - (1 << 64) if x >> 63 else x


def plain(text, k, window):
    """Selected (pos, hash) of a text, window by window."""
    runs = [text[i:i + k] for i in range(len(text) - k + 1)] or ([text] if text else [])
    values = [hash64(r, "utf-32-be") for r in runs]
    out = []
    for a in range(max(len(values) - window + 1, 1) if values else 0):
        at = min(range(a, min(a + window, len(values))), key=lambda i: (values[i] & winnowing.LOW_31, -i))
        if not out or out[-1][0] != at:
            out.append((at, values[at]))
    return out


def like(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows, k=winnowing.K, window=winnowing.WINDOW):
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hash64(r[1])))
    out = []
    for at, (i, t) in enumerate(rows):
        other = rows[(at + 1) % len(rows)][1]
        third = len(t) // 3
        changed = t[:len(t) - third] + other[:third]
        own, new = plain(t, k, window), plain(changed, k, window)
        text = lambda p: " ".join(f"{a}:{h & ((1 << 64) - 1):x}" for a, h in p)
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), text(own), text(new), like(own, new), like(own, plain(other, k, window))))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in winnowing.digests(frame).collect()), key=repr)


@pytest.mark.parametrize("k,window,piece", [(3, 4, 8), (5, 7, 16), (4, 1, 5), (1, 6, 4), (16, 32, 1 << 14)])
def test_fingerprint_equals_every_window(spark, k, window, piece):
    rng = random.Random(k)
    texts = ["".join(rng.choice("ab é🙂\n") for _ in range(rng.randrange(0, 60))) for _ in range(150)] + ["", "a", "aaaaaaaaaaaaaaaaaaaaaaaa" * 5]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    got = {r.n: [tuple(x) for x in r.p] for r in frame.select("n", winnowing.fingerprint(F.col("text"), k, window, piece).alias("p")).collect()}
    assert got == {i: plain(t, k, window) for i, t in enumerate(texts)}


@pytest.mark.parametrize("k,window,piece", [(3, 4, 8), (2, 1, 5), (1, 6, 4), (4, 9, 1 << 14)])
def test_spliced_equals_a_fresh_walk(spark, k, window, piece):
    rng = random.Random(k)
    make = lambda: "".join(rng.choice("ab é") for _ in range(rng.randrange(0, 70)))
    rows = []
    for n in range(300):
        text = make()
        shared = rng.randrange(0, len(text) + 1)
        rows.append((n, text, shared, text[:shared] + make()[:rng.randrange(0, 70)]))
    frame = spark.createDataFrame(rows, "n int, text string, shared int, other string")
    frame = frame.withColumn("prints", winnowing.fingerprint(F.col("text"), k, window, piece))
    got = frame.select("n", winnowing.spliced(F.col("prints"), F.col("shared"), F.col("other"), k, window, piece).alias("p")).collect()
    assert {r.n: [tuple(x) for x in r.p] for r in got} == {n: plain(other, k, window) for n, _, _, other in rows}


def test_shared_passages_share_a_print(spark):
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = make(winnowing.K + winnowing.WINDOW - 1)
    rows = [(k, make(rng.randrange(100)) + shared + make(rng.randrange(100))) for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", winnowing.hashes(winnowing.fingerprint(F.col("text"))).alias("h"))
    sets = [set(r.h) for r in frame.collect()]
    assert all(a & b for a in sets for b in sets)


def test_documents_equal_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, None), (None, "null id"), (1, ""), (2, None), (3, "ab"), (4, "a b c d e f g"), (4, "a b c d e f g"), (4, "other text of the id"),
            (5, "é" * 7), (-6, "日本語🙂" * 9), (7, "word " * 40_000), (1 << 62, "far away" * 8)]
    extra = [(i, t, "x", 1, True) for i, t in rows]
    frame = spark.createDataFrame(extra, "doc_id long, text string, bucket string, tie int, guest boolean")
    assert found(frame) == expected(rows)
    assert found(frame.limit(0)) == []
    assert found(spark.createDataFrame([(9, "only one row of them all, behind itself")], "doc_id long, text string")) == expected([(9, "only one row of them all, behind itself")])


def test_one_id_may_hold_many_rows(spark):
    rows = [(7, f"text number {k} of the id") for k in range(300)] + [(k, f"row {k}") for k in range(100)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == expected(rows)


@pytest.mark.parametrize("k,window,piece", [(2, 8, 3), (3, 12, 1 << 14), (1, 32, 50)])
def test_windows_of_whole_blocks(spark, k, window, piece):
    rng = random.Random(window)
    texts = ["".join(rng.choice("ab é🙂\n") for _ in range(n)) for n in range(110)] + ["a" * n for n in range(0, 90, 7)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    got = {r.n: [tuple(x) for x in r.p] for r in frame.select("n", winnowing.fingerprint(F.col("text"), k, window, piece).alias("p")).collect()}
    assert got == {i: plain(t, k, window) for i, t in enumerate(texts)}


@pytest.mark.parametrize("k,window", [(3, 4), (2, 1), (1, 6), (4, 8)])
def test_only_the_seam_is_walked(spark, k, window):
    rng = random.Random(k)
    make = lambda: "".join(rng.choice("ab é") for _ in range(rng.randrange(0, 70)))
    rows = [(n, a, rng.randrange(0, len(a) + 1), b, rng.randrange(0, len(b) + 1)) for n, a, b in ((n, make(), make()) for n in range(300))]
    frame = spark.createDataFrame([(n, a, at, b, a[:at] + b[:to]) for n, a, at, b, to in rows], "n int, a string, at int, b string, both string")
    frame = frame.select("n", "at", "both", *(winnowing.fingerprint(F.col(c), k, window).alias(c) for c in ("a", "b")))
    joined = lambda a, b: winnowing.spliced(a, F.col("at"), F.col("both"), k, window, behind=b)
    # Marked prints come through as they are, but for those of windows across the seam.
    marked = lambda c: F.transform(c, lambda x: F.struct(x["pos"].alias("pos"), F.shiftleft(x["hash"].bitwiseAND(winnowing.LOW_31), 0).alias("hash")))
    got = frame.select("n", joined(F.col("a"), F.col("b")).alias("p"), joined(marked("a"), marked("b")).alias("m")).collect()
    found = {r.n: ([tuple(x) for x in r.p], [tuple(x) for x in r.m]) for r in got}
    span = k + window - 2
    for n, a, at, b, to in rows:
        every, own = plain(a[:at] + b[:to], k, window), found[n][1]
        assert found[n][0] == every
        assert [p for p, _ in own] == [p for p, _ in every]
        low = lambda h: h & winnowing.LOW_31
        assert all(m == low(h) for (p, m), (_, h) in zip(own, every) if p + k + window <= at - span or p >= at + span + window)
