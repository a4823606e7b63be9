"""Streams run to their end over files made of the tables; the batch result is the check."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework import schemas
from sievework.adapters import AS_OF, TEST_LEXICON
from sievework.catalog.base import NOTICES, query, with_
from sievework.catalog.texts import BASE, REVIEW, SCORES
from sievework.operators.containment import code_detector
from sievework.plans import screening
from sievework.session import shared_folder
from sievework.streaming import chain

FMT = "'%Y-%m-%d %H:%M:%S'"
FIELDS = ("resource_id", "title", "ca", "info", "procedure", "status", "pdf_url")
RECORD = T.StructType([f for f in schemas.NOTICES.fields if f.name in FIELDS])


def _folder(t) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


def _screened(t):
    return screening.screen(t.notices, t.doc_content, code_detector(t.dictionary), TEST_LEXICON, t.authorities)


STAGES = """staged AS (SELECT p.*, CASE WHEN pdf_url = '' OR strlen(trim(pdf_text, E' \\t\\n\\r')) < 100
 THEN 'ai_summary_title_only' ELSE 'ml_prediction' END AS stage FROM predicted p)"""


@query("screen_notices", with_(*BASE, SCORES, REVIEW, STAGES, select="""
SELECT s.resource_id, s.stage AS processing_stage, s.decision, s.ml_status, round(s.ml_confidence, 14) AS ml_confidence, s.ml_reasoning, c.category
FROM staged s JOIN categories c USING (resource_id)"""))
def _(t):
    return _screened(t).select(
        "resource_id", "processing_stage", "decision", "ml_status", "ml_confidence", "ml_reasoning", "category"
    )


@query("stream_chain", with_(*BASE, SCORES, STAGES, select="""
SELECT 'quarantine' AS sink, 'not parseable' AS status, 2 * count(*) AS n FROM staged WHERE resource_id % 50 = 0
UNION ALL SELECT 'title_only', stage, count(*) FROM staged WHERE resource_id % 50 <> 0 AND stage = 'ai_summary_title_only' GROUP BY 2
UNION ALL SELECT 'scored', ml_status, count(*) FROM staged WHERE resource_id % 50 <> 0 AND stage = 'ml_prediction' GROUP BY 2
UNION ALL SELECT 'notices', 'stored', count(*) FROM staged WHERE resource_id % 50 <> 0"""))
def _(t):
    """Notices arrive twice as messages, some cut in half; each whole one is stored and scored once."""
    folder, spark = _folder(t), t.spark
    body = t.notices.select("resource_id", F.to_json(F.struct(*FIELDS)).alias("body"))
    bodies = body.select(F.when(F.col("resource_id") % 50 == 0, F.expr("substring(body, 1, length(body) div 2)")).otherwise(F.col("body")).alias("value"))
    bodies.repartition(4).write.text(f"{folder}/in")
    bodies.repartition(2).write.mode("append").text(f"{folder}/in")
    detect = code_detector(t.dictionary)
    chain.run_to_end(lambda: chain.start_chain(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", RECORD, t.doc_content, detect,
        F.lit(AS_OF).cast("timestamp_ntz"), TEST_LEXICON, t.authorities, files_per_batch=3,
    ))
    sinks = chain.Sinks(f"{folder}/out")
    count = F.count(F.lit(1)).alias("n")
    read = lambda name, fields: sinks.read(spark, name, T._parse_datatype_string(fields))
    parts = [
        read("quarantine", "body string, reason string, attempt int").groupBy(F.col("reason").alias("status")).agg(count),
        read("title_only", "resource_id bigint, processing_stage string").groupBy(F.col("processing_stage").alias("status")).agg(count),
        read("scored", "resource_id bigint, ml_status string").groupBy(F.col("ml_status").alias("status")).agg(count),
        read("notices", "resource_id bigint").select(F.lit("stored").alias("status")).groupBy("status").agg(count),
    ]
    names = ("quarantine", "title_only", "scored", "notices")
    frames = [p.select(F.lit(n).alias("sink"), "status", "n") for n, p in zip(names, parts)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query("redrive_quarantine", with_(*BASE, SCORES, STAGES, select="""
SELECT 'notices' AS sink, 'stored' AS status, count(*) AS n FROM staged WHERE resource_id % 100 <> 50
UNION ALL SELECT 'dead_letters', 'not parseable', count(*) FROM staged WHERE resource_id % 100 = 50
UNION ALL SELECT 'scored', ml_status, count(*) FROM staged WHERE resource_id % 100 = 0 AND stage = 'ml_prediction' GROUP BY 2"""))
def _(t):
    """Bodies without their end are held, tried again, and mended at the second try; those cut in half never are."""
    folder, spark, key = _folder(t), t.spark, F.col("resource_id")
    sinks = chain.Sinks(f"{folder}/out")
    body = t.notices.select("resource_id", F.to_json(F.struct(*FIELDS)).alias("body"))
    cut = F.when(key % 100 == 50, F.expr("substring(body, 1, length(body) div 2)")).when(key % 100 == 0, F.expr("substring(body, 1, length(body) - 1)"))
    chain.ingest_batch(body.select(F.coalesce(cut, "body").alias("body")), 0, sinks, RECORD)
    for mend in (None, lambda bodies: bodies.withColumn("body", F.concat("body", F.lit("}")))):
        chain.run_to_end(lambda: chain.start_redrive(
            spark, sinks.root, f"{folder}/checkpoint", RECORD, t.doc_content, t.detector,
            F.lit(AS_OF).cast("timestamp_ntz"), TEST_LEXICON, t.authorities, mend=mend))
    count = F.count(F.lit(1)).alias("n")
    read = lambda name, fields: sinks.read(spark, name, T._parse_datatype_string(fields))
    parts = [
        read("notices", "resource_id bigint").select(F.lit("notices").alias("sink"), F.lit("stored").alias("status")),
        read("dead_letters", "reason string").select(F.lit("dead_letters").alias("sink"), F.col("reason").alias("status")),
        read("scored", "ml_status string").select(F.lit("scored").alias("sink"), F.col("ml_status").alias("status")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("sink", "status").agg(count)


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _event_stream(t, folder: str, twice: bool = False):
    """The events as JSON files by day, as a stream; ``twice`` delivers each of them two times."""
    events = t.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
    days = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).repartition("day")
    days.write.partitionBy("day").json(f"{folder}/in")
    if twice:
        days.write.mode("append").partitionBy("day").json(f"{folder}/in")
    return t.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 10).json(f"{folder}/in")


HOURLY = f"""
SELECT strftime(date_trunc('hour', ts), {FMT}) AS hour, count(*) AS processed,
 count(CASE WHEN event_type = 'purchase' THEN 1 END) AS successful, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed
FROM events GROUP BY 1"""
HOUR_ROWS = "hour timestamp_ntz, processed bigint, successful bigint, failed bigint"


@query("stream_hourly", HOURLY)
def _(t):
    """The files of the days come in any order, so the hours stay open for the whole month."""
    folder = _folder(t)
    kind = F.col("event_type")
    counts = chain.hourly_stream(_event_stream(t, folder), "ts", kind == "purchase", kind == "error", "31 days")
    sinks = chain.Sinks(f"{folder}/out")
    chain.run_to_end(lambda: chain.write_updates(counts, sinks, "hourly", f"{folder}/checkpoint"))
    return chain.current(sinks, t.spark, "hourly", T._parse_datatype_string(HOUR_ROWS), "hour")


@query("stream_dedupe", "SELECT event_id, event_type, value FROM events")
def _(t):
    """Every event is delivered twice and stored once."""
    folder = _folder(t)
    single = chain.dedupe_stream(_event_stream(t, folder, twice=True), "event_id", "ts", "31 days")
    query_ = single.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(**chain.DAILY)
    chain.run_to_end(query_.start)
    return t.spark.read.parquet(f"{folder}/out").select("event_id", "event_type", "value")


@query("stream_available_now", with_(NOTICES, select="""
SELECT resource_id, title FROM notices WHERE pdf_url = ''"""))
def _(t):
    """A daily run that stops, then a second one over files that came later: nothing is read twice."""
    folder = _folder(t)
    rows = t.notices.select("resource_id", "title", "pdf_url")

    def run() -> None:
        stream = t.spark.readStream.schema(rows.schema).json(f"{folder}/in")
        chain.run_to_end(stream.where("pdf_url = ''").writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).trigger(**chain.DAILY).start)

    early = F.col("published") < F.lit("1998-01-01").cast("timestamp_ntz")
    dated = t.notices.select("resource_id", "title", "pdf_url", early.alias("early"))
    dated.where("early").drop("early").write.json(f"{folder}/in")
    run()
    dated.where("NOT early").drop("early").write.mode("append").json(f"{folder}/in")
    run()
    return t.spark.read.schema(rows.schema).parquet(f"{folder}/out").select("resource_id", "title")
