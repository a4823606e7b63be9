"""Streams: replays, repeats, late restarts."""

import json

import pytest
from pyspark.sql import functions as F

from sievework import schemas
from sievework.operators.containment import code_detector
from sievework.streaming import chain

SCHEMA = schemas.T.StructType([f for f in schemas.NOTICES.fields if f.name in ("resource_id", "title", "ca", "pdf_url")])
def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def body(key, title="software support", url="u"):
    return json.dumps({"resource_id": key, "title": title, "ca": "c", "pdf_url": url})


@pytest.fixture()
def tables(spark):
    docs = spark.createDataFrame([(1, "software support 72000000 " * 10), (2, "short"), (3, "road works bridge " * 20)], "resource_id long, pdf_text string")
    return docs, code_detector(spark.createDataFrame([("72000000", 0)], "code string, code_pos int"))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    sinks = chain.Sinks(str(tmp_path))
    frame = lambda *bodies: spark.createDataFrame([(b,) for b in bodies], "body string")
    first, second = frame(body(1), body(2), "broken"), frame(body(2, "again"), body(3), body(3, "last"))
    for _ in range(2):  # batch 0 runs twice, as after a failure
        assert chain.ingest_batch(first, 0, sinks, SCHEMA).count() == 2
    for _ in range(2):
        fresh = chain.ingest_batch(second, 1, sinks, SCHEMA)
        assert [(r["resource_id"], r["title"]) for r in fresh.collect()] == [(3, "last")]
    stored = sinks.read(spark, "notices", SCHEMA)
    assert sorted(r["resource_id"] for r in stored.collect()) == [1, 2, 3]
    assert spark.read.parquet(sinks.path("quarantine")).count() == 1


def test_chain_runs_and_resumes(spark, tmp_path, tables):
    docs, detect = tables
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def run():
        chain.run_to_end(lambda: chain.start_chain(
            spark, str(source), root, str(tmp_path / "checkpoint"), SCHEMA, docs, detect, now(), files_per_batch=1,
        ))

    (source / "a.txt").write_text("\n".join([body(1), body(2), body(4, url=""), "no json"]))
    (source / "b.txt").write_text("\n".join([body(1, "repeat"), body(3)]))
    run()
    (source / "c.txt").write_text(body(2, "known") + "\n" + body(5))
    run()
    sinks = chain.Sinks(root)
    scored = {r["resource_id"]: r for r in spark.read.parquet(sinks.path("scored")).collect()}
    assert set(scored) == {1, 3}
    assert scored[1]["codes_count"] == 1 and scored[1]["ml_status"] == "bid" and scored[1]["priority"] == "URGENT"
    assert scored[3]["ml_status"] == "no-bid" and scored[3]["ml_reasoning"].startswith("HARD_EXCLUSION")
    assert {r["resource_id"] for r in spark.read.parquet(sinks.path("title_only")).collect()} == {2, 4, 5}
    assert spark.read.parquet(sinks.path("notices")).count() == 5


def test_held_messages_are_tried_again(spark, tmp_path, tables):
    docs, detect = tables
    sinks = chain.Sinks(str(tmp_path / "out"))
    chain.ingest_batch(spark.createDataFrame([(body(1),), (body(3)[:-1],), ("no json",)], "body string"), 0, sinks, SCHEMA)
    close = lambda bodies: bodies.withColumn("body", F.concat("body", F.lit("}")))

    def redrive(mend=None):
        chain.run_to_end(lambda: chain.start_redrive(spark, sinks.root, str(tmp_path / "again"), SCHEMA, docs, detect, now(), mend=mend))
        read = lambda name, kind: spark.read.schema(kind).parquet(sinks.path(name)).collect()
        held = {(r["body"], r["attempt"]) for r in read("quarantine", chain.HELD)}
        dead = {r["body"] for r in read("dead_letters", chain.HELD)}
        return held, dead, sorted(r["resource_id"] for r in sinks.read(spark, "notices", SCHEMA).collect())

    bad = {body(3)[:-1], "no json"}
    held, dead, known = redrive()
    assert held == {(b, n) for b in bad for n in (1, 2)} and not dead and known == [1]
    held, dead, known = redrive(close)
    assert dead == {"no json}"} and known == [1, 3]
    assert redrive(close)[1:] == (dead, known)            # nothing is left
    assert {r["resource_id"] for r in spark.read.parquet(sinks.path("scored")).collect()} == {3}


def test_the_last_file_counts(spark, tmp_path):
    """Of two bodies with one key the one in the later file counts, however files are packed."""
    import os
    (tmp_path / "in").mkdir()
    for name, title, at in (("a.txt", "late", 2_000_000_000), ("b.txt", "early", 1_900_000_000)):
        (tmp_path / "in" / name).write_text(body(1, title))
        os.utime(tmp_path / "in" / name, (at, at))
    sinks = chain.Sinks(str(tmp_path / "out"))
    stream = chain.read_bodies(spark, str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(lambda b, i: chain.ingest_batch(b, i, sinks, SCHEMA)).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert [r["title"] for r in sinks.read(spark, "notices", SCHEMA).collect()] == ["late"]


def test_hourly_stream_equals_the_batch(spark, tmp_path):
    events = spark.range(500).select(
        (F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 7).cast("int"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, "failed").otherwise("success").alias("status"),
    )
    events.repartition(4).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, status string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    ok, bad = F.col("status") == "success", F.col("status") == "failed"
    sinks = chain.Sinks(str(tmp_path / "out"))
    counts = chain.hourly_stream(stream, "ts", ok, bad, "10 days")
    chain.run_to_end(lambda: chain.write_updates(counts, sinks, "hourly", str(tmp_path / "checkpoint")))
    rows = schemas.T._parse_datatype_string("hour timestamp_ntz, processed bigint, successful bigint, failed bigint")
    got = {tuple(r) for r in chain.current(sinks, spark, "hourly", rows, "hour").collect()}
    want = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz")).agg(F.count(F.lit(1)), F.count_if(ok), F.count_if(bad))
    assert got == {tuple(r) for r in want.collect()}
