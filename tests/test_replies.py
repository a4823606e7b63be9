"""Replies, messages, notifications."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework import schemas
from sievework.functions import reply
from sievework.sources import messages


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, reply string")


@pytest.mark.parametrize("text, want", [
    ('  {"a": 1}\n', '{"a": 1}'),
    ('so:\n```json\n{"a": 1}\n``` bye', '{"a": 1}'),
    ('so:\n```json {"a": {"b": 2}} never closed', '{"a": {"b": 2}}'),
    ('before {"a": {"b": 2}} after } {', '{"a": {"b": 2}}'),
    ("open { only", "open { only"),
    ("no json", "no json"),
    ("} first {x} then", "{x}"),
    ("", ""),
])
def test_extract_json(spark, text, want):
    assert frame(spark, [text]).select(reply.extract_json("reply").alias("j")).first()["j"] == want


def test_extract_json_is_linear_in_the_text(spark):
    long = "{ " + "x" * 200_000
    assert frame(spark, [long]).select(F.length(reply.extract_json("reply")).alias("n")).first()["n"] == len(long)


def test_parsed_reply(spark):
    body = json.dumps({"summary": "Plumbing job, override", "key_points": ["a", 3, "b", None], "recommendation": "NO BID"})
    row = reply.normalize_reply(frame(spark, [body])).first()
    assert row["ai_summary"] == "Plumbing job, override" and row["key_points"] == ["a", "b"]
    assert row["confidence_assessment"] == fv.CONFIDENCE_MISSING
    assert row["processing_notes"] == [fv.NOTE_PARSED, fv.NOTE_OVERRIDE, fv.NOTE_INDICATOR + "plumbing", fv.NOTE_NO_BID]


@pytest.mark.parametrize("body, parsed", [
    ('{"a": 1} trailing {"b": 2}', False), ("[1, 2]", True), ("42", True), ("nope", False), ('{"a": 1}, {"b": 2}', False), ('{"a": 1', False),
])
def test_only_whole_json_counts(spark, body, parsed):
    row = reply.normalize_reply(frame(spark, [body])).first()
    assert (row["processing_notes"] != [fv.NOTE_PLAIN]) == parsed
    assert row["ai_summary"] == body


@pytest.mark.parametrize("text, want", [
    ("We should bid, no bid otherwise", "BID"), ("I say: NO BID", "NO BID"), ("don't bid", "NO BID"),
    ("a technical opportunity", "BID - IT opportunity identified"), ("hm", fv.RECOMMENDATION_FALLBACK),
])
def test_plain_recommendation(spark, text, want):
    assert frame(spark, [text]).select(reply.recommend_from_text("reply").alias("r")).first()["r"] == want


def notices(spark, rows):
    return spark.createDataFrame(rows, "recommendation string, processing_notes array<string>, should_bid boolean, summary_type string")


@pytest.mark.parametrize("row, notify, strict", [
    (("BID", [], False, ""), True, True), (("NO BID", [], True, ""), False, False), (("do not bid", [], True, ""), True, False),
    (("See summary", [], True, ""), False, False),
    ((fv.RECOMMENDATION_FALLBACK, [fv.NOTE_PLAIN], True, ""), True, True),
    ((fv.RECOMMENDATION_FALLBACK, [fv.NOTE_PLAIN], False, ""), False, False),
])
def test_notify(spark, row, notify, strict):
    got = notices(spark, [row]).select(reply.should_notify().alias("a"), reply.should_notify(strict=True).alias("b")).first()
    assert (got["a"], got["b"]) == (notify, strict)


@pytest.mark.parametrize("row, priority", [
    (("", [fv.NOTE_OVERRIDE], True, "FULL_PDF"), "CRITICAL"), (("", [], True, "FULL_PDF"), "URGENT"),
    (("", [fv.NOTE_INDICATOR + "food"], True, "FULL_PDF"), "MEDIUM"), (("", [fv.NOTE_OVERRIDE], False, "FULL_PDF"), "HIGH"),
    (("", [], False, "TITLE_ONLY"), "NORMAL"),
])
def test_priority(spark, row, priority):
    assert notices(spark, [row]).select(reply.notify_priority().alias("p")).first()["p"] == priority


def test_recipients(spark):
    df = spark.createDataFrame([("a@b.c, ,bad,@x.y,u@v,a@b@c.d , z@. ",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(reply.valid_recipients("s")).collect()] == [["a@b.c", "z@."], [], []]
    assert reply.notification_fanout(df, F.lit("")).count() == 0


def test_digest_defaults(spark):
    payload = json.dumps({"resource_id": "5", "title": "T", "priority": "HIGH", "summary": "S", "timestamp": "2025-01-02T03:04:05.678Z",
                          "metadata": json.dumps({"ml_prediction": {"confidence": 0.567}, "key_points": "none"})})
    row = reply.digest_rows(spark.createDataFrame([(payload,)], "payload string"), "u=").first()
    assert row["contracting_authority"] == "Unknown Authority" and row["prediction_confidence"] == 57.0
    assert row["timestamp"] == "2025-01-02 03:04:05 UTC" and row["portal_link"] == "u=5" and row["ai_summary"] == "S"
    assert row["key_points"] == ["See summary for details"] and row["deadline"] is None


def test_digest_leaves_out_what_is_missing(spark):
    payload = json.dumps({"resource_id": "5", "title": "T", "priority": "HIGH", "summary": "", "timestamp": "2025-01-02T03:04:05Z", "metadata": {}})
    rows = reply.digest_rows(spark.createDataFrame([(payload,)], "payload string"), "u=")
    digest = rows.select(reply.digest_text().alias("d")).first()["d"]
    assert "Deadline" not in digest and "KEY POINTS" not in digest and "VIEW FULL NOTICE" in digest


def test_messages(spark):
    scored = {"resource_id": "7", "tender_title": "T", "ml_prediction": {"should_bid": False, "confidence": 0.2, "feature_scores": {}},
              "priority": "URGENT", "timestamp": "2025-01-02T03:04:05Z"}
    bare = {"resource_id": 8, "title": "B", "ca": "x"}
    bodies = [json.dumps(scored), json.dumps(bare), '{"resource_id": "9', json.dumps(scored | {"resource_id": "x"}), None]
    now = F.lit("2025-06-01 00:00:00").cast("timestamp_ntz")
    rows = messages.normalize_union_messages(spark.createDataFrame([(b,) for b in bodies], "body string"), now=now).collect()
    by = {r["body"]: r for r in rows}
    a, b = by[bodies[0]], by[bodies[1]]
    assert a["reason"] is None and a["resource_id"] == 7 and a["ml_prediction"]["reasoning"] == fv.MISSING_REASONING
    assert a["ml_prediction"]["feature_scores"]["ca_score"] == 0.0 and a["pdf_content"] == "" and a["timestamp"] == datetime(2025, 1, 2, 3, 4, 5)
    assert b["ml_prediction"]["should_bid"] is True and b["ml_prediction"]["confidence"] == 0.5 and b["priority"] == "NORMAL"
    assert [by[x]["reason"] for x in bodies[2:]] == ["not parseable", "bad key", "no body"]


def test_one_bad_body_does_not_fail_the_rest(spark):
    schema = schemas.T.StructType([schemas.NOTICES["resource_id"], schemas.NOTICES["title"]])
    bodies = spark.createDataFrame([('{"resource_id": 1, "title": "a"}',), ("oops",), ('{"title": "no key"}',)], "body string")
    parsed = messages.parse_messages(bodies, schema)
    assert [tuple(r) for r in messages.good_records(parsed).collect()] == [(1, "a")]
    assert sorted(r["reason"] for r in messages.quarantined(parsed).collect()) == ["not parseable", "required field missing"]


def test_prompt_template(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    got = df.select(reply.fill_template("{a}-{b}{a} {c}", {"a": F.col("a"), "b": F.col("b")}).alias("p")).first()["p"]
    assert got == "x-yx {c}"


def test_the_last_of_repeated_fields_counts(spark):
    df = spark.createDataFrame([('{"summary": "one", "summary": "two", "recommendation": "BID"}',)], "reply string")
    row = reply.normalize_reply(df).first()
    assert row["ai_summary"] == "two" and row["recommendation"] == "BID"
