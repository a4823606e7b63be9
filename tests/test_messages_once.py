"""A message is parsed once, however often its record is used."""

from pyspark.sql import functions as F

from sievework import schemas
from sievework.sources import messages


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_union_messages_are_parsed_once(spark):
    bodies = spark.createDataFrame([('{"resource_id": "7", "title": "t"}',), ("{",), (None,), ('{"title": "no key"}',)], "body string")
    shaped = messages.normalize_union_messages(bodies.withColumn("body", F.trim("body")))
    good = shaped.where("reason IS NULL").select("resource_id", "title", "ml_prediction.reasoning", "priority")
    assert plan(good).count("from_json") == 1
    assert [tuple(r)[:2] for r in good.collect()] == [(7, "t")]
    assert sorted(r.reason or "" for r in shaped.collect()) == ["", "no body", "not parseable", "required field missing"]


def test_rejected_messages_are_parsed_once(spark):
    bodies = spark.createDataFrame([("{",), ('{"resource_id": "7"}',), (None,)], "body string")
    held = messages.quarantined(messages.parse_messages(bodies, schemas.UNION_MESSAGE))
    assert plan(held).count("from_json") == 1
    assert sorted((r.body or "", r.reason, r.attempt) for r in held.collect()) == [("", "no body", 1), ("{", "not parseable", 1)]


def test_scored_messages_are_read_in_one_parse(spark):
    from sievework.catalog import load

    rows = load()[0]["scored_message"](spark, "/root/testdata/sf0.001")
    assert plan(rows).count("get_json_object") == 0
    assert plan(rows).count("from_json") == 1
    assert rows.where("text_bytes > 0").count() > 0
