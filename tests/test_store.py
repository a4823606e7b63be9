"""Upserts, updates, searches, joins, sums and quantiles over whole tables."""

import random
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from sievework.operators import joins, monitor, search, upsert
from sievework.operators.running import exact_quantiles, running_totals
from sievework.plans import screening
from sievework.sources import store

def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def notices(spark, data):
    df = spark.createDataFrame(data, "resource_id long, title string, bid int, ml_status string")
    return store.migrate_notices(df)


def test_upsert_keeps_labels_and_predictions(spark):
    stored = notices(spark, [(1, "old", 1, "bid"), (2, "kept", 0, "pending")])
    incoming = spark.createDataFrame(
        [(1, "first", 1), (1, "last", 3), (1, "middle", 2), (3, "new", 1)], "resource_id long, title string, arrival int"
    )
    once = upsert.upsert_notices(stored, incoming, order_by="arrival")
    want = [(1, "last", 1, "bid"), (2, "kept", 0, "pending"), (3, "new", None, "pending")]
    assert rows(once, "resource_id", "title", "bid", "ml_status") == want
    again = upsert.upsert_notices(once, incoming, order_by="arrival")
    assert rows(again, "resource_id", "title", "bid", "ml_status") == want
    assert again.dtypes == stored.dtypes


def test_a_hot_key_in_the_batch_gives_one_row(spark):
    # Every third arrival is of one key.
    batch = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") + 100).alias("resource_id"), F.col("id").alias("arrival"),
        F.col("id").cast("string").alias("title"),
    )
    last = upsert.latest_by_key(batch, "resource_id", "arrival")
    assert last.count() == 20_001 and last.where("resource_id = 5").first()["title"] == "29997"


def test_anti_and_semi_give_the_batch_back(spark):
    batch = spark.range(100).withColumnRenamed("id", "resource_id")
    stored = spark.range(50, 200).withColumnRenamed("id", "resource_id")
    new = upsert.filter_new_records(batch, stored)
    known = batch.join(stored, "resource_id", "left_semi")
    assert rows(new.unionByName(known), "resource_id") == rows(batch, "resource_id") and new.count() == 50


def test_labels(spark):
    stored = notices(spark, [(1, "a", None, ""), (2, "b", 1, ""), (3, "c", 0, "")])
    answers = spark.createDataFrame(
        [(1, " Yes ", 1), (2, "y", 1), (2, "n", 2), (2, "?", 3), (3, "perhaps", 1), (9, "y", 1)], "resource_id long, answer string, at int"
    )
    assert rows(upsert.apply_labels(stored, answers, "at"), "resource_id", "bid") == [(1, 1), (2, 0), (3, 0)]
    assert rows(upsert.unmatched_updates(stored, answers), "resource_id") == [(9,)]


def test_predictions_are_written_back(spark):
    stored = notices(spark, [(1, "a", None, "pending"), (2, "b", None, "pending")])
    decided = spark.createDataFrame([(1, True, 0.25, "why", "bid")], "resource_id long, ml_bid boolean, ml_confidence double, ml_reasoning string, ml_status string")
    one, two = upsert.update_predictions(stored, decided.union(decided).withColumn("at", F.lit(1)), now(), "at").orderBy("resource_id").collect()
    assert (one["ml_status"], one["ml_processed"], float(one["ml_confidence"]), one["updated_at"]) == ("bid", True, 0.25, datetime(2025, 1, 1))
    assert (two["ml_status"], two["ml_processed"], two["updated_at"]) == ("pending", False, None)


def test_summaries_keep_their_birthday(spark):
    at = lambda day: F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz")
    old = spark.createDataFrame([(1, "old")], "resource_id long, ai_summary string").withColumns({"created_at": at(1), "updated_at": at(1)})
    new = spark.createDataFrame([(1, "new"), (2, "two")], "resource_id long, ai_summary string").withColumn("created_at", at(2))
    got = {r["resource_id"]: r for r in upsert.upsert_summaries(old, new.union(new).withColumn("at", F.lit(1)), now(), "at").collect()}
    assert got[1]["created_at"] == datetime(2024, 1, 1) and got[1]["ai_summary"] == "new" and got[1]["updated_at"] == datetime(2025, 1, 1)
    assert got[2]["created_at"] == datetime(2024, 1, 2)


def test_a_mark_sent_twice_repeats_nothing(spark):
    stored = notices(spark, [(1, "a", None, ""), (2, "b", None, "")])
    sent = spark.createDataFrame([(1,), (1,), (2,)], "resource_id long")
    assert rows(upsert.mark_notified(stored, sent, now()), "resource_id", "notification_sent") == [(1, True), (2, True)]


def test_keys_are_typed_before_they_are_compared(spark):
    raw = spark.createDataFrame([("a", "7", 1), ("b", "007", 2), ("c", "x", 1), ("d", "y", 3)], "title string, resource_id string, arrival int")
    for c in ("ca", "info", "published", "deadline", "procedure", "status", "pdf_url", "awarddate", "value", "cycle"):
        raw = raw.withColumn(c, F.lit(""))
    merged, _fresh = screening.ingest(raw, notices(spark, [(1, "old", 1, "bid")]), "arrival")
    assert rows(merged, "resource_id", "title") == [(0, "d"), (1, "old"), (7, "b")]


def test_ingest(spark):
    stored = notices(spark, [(1, "old", 1, "bid")])
    raw = spark.createDataFrame(
        [("T1", "1", "u", 1), ("T2", "2", "", 1), ("T2b", "2", "u", 2), ("bad", "x", "", 1)],
        "title string, resource_id string, pdf_url string, arrival int",
    )
    for c in ("ca", "info", "published", "deadline", "procedure", "status", "awarddate", "value", "cycle"):
        raw = raw.withColumn(c, F.lit(""))
    merged, fresh = screening.ingest(raw, stored, "arrival")
    assert rows(merged, "resource_id", "title") == [(0, "bad"), (1, "T1"), (2, "T2b")]
    assert rows(fresh, "resource_id", "route") == [(0, "direct"), (2, "documents")]


def test_search(spark):
    df = spark.createDataFrame(
        [(1, "Software", "x", "", "2024-01-01 00:00:00", "Open", 5.0), (2, "b", "SOFT co", "", None, "Closed", None),
         (3, "c", "x", "hard soft", "2024-02-01 00:00:00", "open", 50.0), (4, "d", "y", "z", "2024-03-01 00:00:00", "Open", 500.0)],
        "resource_id long, title string, ca string, info string, published string, status string, value double",
    ).withColumns({"published": F.col("published").cast("timestamp_ntz"), "deadline": F.lit("2024-05-01").cast("timestamp_ntz"), "pdf_url": F.lit("")})
    found = search.search_notices(df, "soft").collect()
    assert [r["resource_id"] for r in found] == [2, 3, 1]  # NULL dates come first, newest next
    assert [r["resource_id"] for r in search.search_notices(df, "soft", 1).collect()] == [2]
    assert [r["resource_id"] for r in search.filter_notices(df).collect()] == [2, 4, 3, 1]
    assert [r["resource_id"] for r in search.filter_notices(df, status="OPEN", min_value=50).collect()] == [4, 3]
    near = search.find_opportunities(df, ["soft"], "2024-04-25", 6).collect()
    assert [(r["resource_id"], r["days_remaining"]) for r in near] == [(1, 6), (3, 6)]
    assert search.find_opportunities(df, ["soft"], "2024-04-25", 7).count() == 0


def test_pending(spark):
    df = spark.createDataFrame([(1, "u"), (2, ""), (3, "u"), (4, None)], "resource_id long, pdf_url string")
    docs = spark.createDataFrame([(3, "x"), (3, "again")], "resource_id long, pdf_text string")
    assert joins.pending_count(df, docs).first()["pending"] == 1
    assert joins.mark_processed(df, docs).count() == 4


def test_correlation_skips_constant_columns(spark):
    rng = np.random.default_rng(1)
    data = [(float(a), float(a * 2 + b), 7.0, None if i % 4 else float(b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)) + 1e6)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["corr"] for r in monitor.correlations(df, ["a", "b", "c", "d"]).collect()}
    assert set(got) == {("a", "b"), ("a", "d"), ("b", "d")}
    x = np.array([[v if v is not None else np.nan for v in r] for r in data])
    both = ~np.isnan(x[:, 3])
    assert abs(got["a", "b"] - np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 1e-6
    assert abs(got["b", "d"] - np.corrcoef(x[both, 1], x[both, 3])[0, 1]) < 1e-6


def test_running_totals_with_a_hot_value(spark):
    rng = random.Random(5)
    values = [0.5 if rng.random() < 1 / 3 else rng.random() for _ in range(5000)]
    counts = spark.createDataFrame([(v,) for v in values], "score double").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    for slices in (1, 7, 64):
        got = {r["score"]: r["cum_n"] for r in running_totals(counts, "score", ["n"], slices=slices).collect()}
        ordered = np.sort(values)
        assert all(got[v] == len(values) - np.searchsorted(ordered, v) for v in set(values))


def test_running_totals_per_group(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"), F.lit(1).alias("n"))
    got = running_totals(df, "k", ["n"], by="g", slices=5)
    assert got.where("cum_n != floor((2999 - k) / 3) + 1").count() == 0 and got.count() == 3000


def test_quantiles(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=1001), "b": np.where(rng.random(1001) < 0.4, 3.0, rng.random(1001))}
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(data["a"], data["b"])] + [(None, None)], "a double, b double")
    fractions = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    # A rough sketch and a low limit make it narrow its brackets.
    for limits in ({}, {"accuracy": 20, "most": 8}, {"accuracy": 200, "most": 0}):
        got = {(r["column"], r["fraction"]): r["value"] for r in exact_quantiles(df, ["a", "b"], fractions, **limits).collect()}
        assert len(got) == 12
        for (c, f), v in got.items():
            assert abs(v - np.quantile(data[c], f)) < 1e-12
    assert exact_quantiles(df.where("a is null"), ["a", "b"], fractions).collect() == []
    assert [r["value"] for r in exact_quantiles(df.limit(1), ["a"], [0.5, 1.0]).collect()] == [data["a"][0]] * 2


def test_bands_and_buckets(spark):
    counts = spark.createDataFrame([(str(n), n) for n in (1, 2, 5, 6, 20, 21, 100, 101, 5000)], "code string, n long")
    got = {r["band"]: r["n_codes"] for r in monitor.frequency_bands(counts).collect()}
    assert got == {"1": 1, "2-5": 2, "6-20": 2, "21-100": 2, "101+": 2}


def test_versions_leave_the_old_one_readable(spark, tmp_path):
    first = spark.range(3).withColumnRenamed("id", "resource_id").withColumn("title", F.lit("a"))
    path = store.write_version(first, str(tmp_path), 1)
    current = spark.read.parquet(path)
    newer = store.write_version(upsert.upsert(current, spark.createDataFrame([(2, "b", 1)], "resource_id long, title string, at int"), "at"), str(tmp_path), 2)
    assert rows(spark.read.parquet(newer), "title") == [("a",), ("a",), ("b",)] and spark.read.parquet(path).count() == 3
