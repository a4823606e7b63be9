"""The stages as one stream: files in, stored notices, scores, title-only messages and quarantine out.

Delivery is at least once: a batch may run twice after a failure. Every sink therefore writes its
batch into a folder of its own name and replaces what an earlier try left there, and known keys
are looked up among *other* batches only. The batch is acknowledged when all sinks are written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from sievework.operators import scoring, upsert
from sievework.operators.lexicon import Lexicon
from sievework.plans import screening
from sievework.sources import messages

DAILY = {"availableNow": True}
QUICK = {"processingTime": "5 seconds"}
KEY_SLOTS = 1 << 25             # bits that stand for the keys of a batch, 4 MB


@dataclass(frozen=True)
class Sinks:
    """Folders below one root; each holds ``batch=<id>`` folders."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path(name)}/batch={batch_id}")

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """All batches of a sink; an empty frame before the first one."""
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        try:
            return spark.read.schema(with_batch).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # No batch has been written yet.
            return spark.createDataFrame([], with_batch)


def read_bodies(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    """Message bodies, one per line, a bounded number of files at a time."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    came = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
    return lines.select(F.col("value").alias("body"), came.alias("arrival"))


def ingest_batch(
    bodies: DataFrame, batch_id: int, sinks: Sinks, schema: T.StructType, max_attempts: int = 3
) -> DataFrame:
    """Parse, set bad bodies aside, drop known keys, store the rest; returns the new notices.

    Of several bodies with one key the last counts: by ``arrival``, where the bodies have it, and by their order.
    Bodies with an ``attempt`` were tried as often before.
    """
    spark = bodies.sparkSession
    parsed = messages.parse_messages(bodies, schema)
    held = messages.quarantined(parsed)
    again, dead = messages.retry_candidates(held, max_attempts)
    sinks.write(again, "quarantine", batch_id)
    sinks.write(dead, "dead_letters", batch_id)
    order = F.struct(*(["arrival"] if "arrival" in parsed.columns else []), F.monotonically_increasing_id())
    good = messages.good_records(parsed.withColumn("record", F.col("record").withField("_arrival", order)))
    single = upsert.latest_by_key(good, "resource_id", "_arrival").drop("_arrival")
    stored = sinks.read(spark, "notices", single.schema).where(F.col("batch") != batch_id)
    fresh = upsert.filter_new_records(single, stored)
    sinks.write(fresh, "notices", batch_id)
    return spark.read.schema(single.schema).parquet(f"{sinks.path('notices')}/batch={batch_id}")


def only_keys(docs: DataFrame, wanted: DataFrame, key: str = "resource_id") -> DataFrame:
    """The rows of ``docs`` whose key is among those ``wanted``, and some others; they stay where they are read.

    A bit for each of ``KEY_SLOTS`` hashes of keys tells whether one of them is wanted. The bits come as one
    row for each 32,768 of them, whose number is fixed, so they are sent to the tasks and the texts are not
    shuffled. A join by key has to follow, which leaves the others out.
    """
    # In the type of the wanted ones, since equal numbers of two types have two hashes.
    slot = F.pmod(F.xxhash64(F.col(key).try_cast(wanted.schema[key].dataType)), F.lit(KEY_SLOTS))
    places = wanted.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_place"))
    bits = places.groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = docs.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("_bucket"))
    return near.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*docs.columns)


def score_batch(
    fresh: DataFrame, batch_id: int, sinks: Sinks, docs: DataFrame, detect: screening.Detector, now: Column,
    lexicon: Lexicon | None = None, authorities: Mapping[str, int] | None = None,
) -> None:
    """Texts of the new notices to codes and scores; short or missing texts go on with their title only."""
    own = only_keys(docs, fresh)
    rows = fresh.join(screening.document_features(own, detect, lexicon), "resource_id", "left")
    staged = rows.withColumn("processing_stage", screening.next_stage()).persist(StorageLevel.MEMORY_AND_DISK)
    direct = staged.where("processing_stage = 'ai_summary_title_only'").withColumn("pdf_text", F.lit(""))
    sinks.write(
        messages.title_only_message(direct, now).select("resource_id", "processing_stage", "body"), "title_only", batch_id
    )
    scored = scoring.predict_rule(staged.where("processing_stage = 'ml_prediction'"), lexicon, authorities)
    sinks.write(
        scored.select("resource_id", "title", "codes_count", "ml_bid", "ml_confidence", "ml_status", "ml_reasoning",
                      scoring.message_priority("ml_bid").alias("priority")),
        "scored", batch_id,
    )
    staged.unpersist()


def start_chain(
    spark: SparkSession, folder: str, root: str, checkpoint: str, schema: T.StructType, docs: DataFrame,
    detect: screening.Detector, now: Column, lexicon: Lexicon | None = None,
    authorities: Mapping[str, int] | None = None, trigger: Mapping = DAILY, files_per_batch: int = 10,
) -> StreamingQuery:
    """Start the chain (T01-T03); ``trigger`` is a daily run over what is there, or every few seconds."""
    sinks = Sinks(root)

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = ingest_batch(batch, batch_id, sinks, schema)
        score_batch(fresh, batch_id, sinks, docs, detect, now, lexicon, authorities)

    bodies = read_bodies(spark, folder, files_per_batch)
    return bodies.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


HELD = "body string, reason string, attempt int, batch long"


def start_redrive(
    spark: SparkSession, root: str, checkpoint: str, schema: T.StructType, docs: DataFrame, detect: screening.Detector,
    now: Column, lexicon: Lexicon | None = None, authorities: Mapping[str, int] | None = None,
    mend: Callable[[DataFrame], DataFrame] | None = None, max_attempts: int = 3, trigger: Mapping = DAILY,
) -> StreamingQuery:
    """Try the held messages of the chain at ``root`` again.

    Each run takes what has come into the quarantine since the last one, so the time between runs is the
    delay between tries. A message that can be read now goes on like any other, one that cannot returns
    to the quarantine with one try more, and after ``max_attempts`` to the dead letters. ``mend`` may repair bodies
    or change how they are read; batches have negative numbers, apart from those of the chain.
    """
    sinks = Sinks(root)

    def run(batch: DataFrame, batch_id: int) -> None:
        bodies = batch.select("body", "attempt")
        fresh = ingest_batch(mend(bodies) if mend else bodies, -1 - batch_id, sinks, schema, max_attempts)
        score_batch(fresh, -1 - batch_id, sinks, docs, detect, now, lexicon, authorities)

    held = spark.readStream.schema(HELD).parquet(sinks.path("quarantine"))
    return held.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def hourly_stream(events: DataFrame, ts: str, success: Column, failed: Column, lateness: str = "1 hour") -> DataFrame:
    """Hourly counts on a stream; the watermark bounds the hours kept open."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))  # a watermark needs an instant
    return timed.withWatermark(ts, lateness).groupBy(F.window(ts, "1 hour")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(success).alias("successful"), F.count_if(failed).alias("failed")
    ).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "processed", "successful", "failed")


def write_updates(df: DataFrame, sinks: Sinks, name: str, checkpoint: str, trigger: Mapping = DAILY) -> StreamingQuery:
    """Changed rows of an aggregate, one folder per batch; the last batch of a key holds."""
    return df.writeStream.outputMode("update").foreachBatch(lambda batch, i: sinks.write(batch, name, i)).option(
        "checkpointLocation", checkpoint
    ).trigger(**trigger).start()


def current(sinks: Sinks, spark: SparkSession, name: str, schema: T.StructType, key: str) -> DataFrame:
    """The latest row of each key over all batches."""
    return upsert.latest_by_key(sinks.read(spark, name, schema), key, "batch").drop("batch")


def dedupe_stream(records: DataFrame, key: str, ts: str, lateness: str = "1 hour") -> DataFrame:
    """Each key once, remembered for as long as the watermark allows repeats."""
    timed = records.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def run_to_end(start: Callable[[], StreamingQuery], timeout: int = 3600) -> None:
    """Run a daily-trigger query until it has read everything."""
    query = start()
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout} s")
