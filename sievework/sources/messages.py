"""Message bodies to records: parsing, defaults, the union of two shapes, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework import fixed_values as fv
from sievework import schemas
from sievework.functions import clean

CORRUPT = "_corrupt_record"


def parse_messages(
    messages: DataFrame, schema: T.StructType, body: str = "body", required: Sequence[str] = ("resource_id",)
) -> DataFrame:
    """Every message with its parsed ``record`` and, where it cannot be used, the ``reason``.

    One bad body never fails the batch; the same expression serves batch and stream (S08, T07). A body is parsed
    once: as a row of its own the record stays one column, which a plain one would not where a filter or several
    fields use it.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(body, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = messages.drop("record").select("*", F.explode(F.array(record)).alias("record"))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"record.{name}").isNull()
    return parsed.withColumn(
        "reason",
        F.when(F.col(body).isNull(), "no body")
        .when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), "not parseable")
        .when(missing, "required field missing"),
    ).withColumn("record", F.col("record").dropFields(CORRUPT))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("record.*")


def quarantined(parsed: DataFrame, body: str = "body", attempt: Column | None = None) -> DataFrame:
    """Rejected bodies with their reason and how often they were tried."""
    tries = attempt if attempt is not None else (F.col("attempt") if "attempt" in parsed.columns else F.lit(0))
    return parsed.where(F.col("reason").isNotNull()).select(
        F.col(body).alias("body"), "reason", (tries + 1).cast("int").alias("attempt")
    )


def retry_candidates(quarantine: DataFrame, max_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(bodies to try again, dead letters): a body is given up after ``max_attempts``."""
    again = F.col("attempt") < max_attempts
    return quarantine.where(again), quarantine.where(~again)


def with_defaults(prediction: str = "ml_prediction") -> Column:
    """A prediction struct with missing reasoning and scores filled in."""
    p = F.col(prediction)
    scores = F.struct(*[
        F.coalesce(p["feature_scores"][f.name], F.lit(0.0)).alias(f.name) for f in schemas.COMPONENT_SCORES.fields
    ])
    filled = F.struct(
        p["should_bid"].alias("should_bid"), p["confidence"].alias("confidence"),
        F.coalesce(p["reasoning"], F.lit(fv.MISSING_REASONING)).alias("reasoning"), scores.alias("feature_scores"),
    )
    return F.when(p.isNotNull(), filled)


def prediction_literal(should_bid: bool, confidence: float, reasoning: str) -> Column:
    zero = F.struct(*[F.lit(0.0).alias(f.name) for f in schemas.COMPONENT_SCORES.fields])
    return F.struct(
        F.lit(should_bid).alias("should_bid"), F.lit(confidence).alias("confidence"),
        F.lit(reasoning).alias("reasoning"), zero.alias("feature_scores"),
    )


def normalize_union_messages(messages: DataFrame, body: str = "body", now: Column | None = None) -> DataFrame:
    """Scored messages and bare records to one shape.

    A body with a prediction is a scored message, whose key is text; any other is a bare record
    and gets the neutral prediction and normal priority.
    """
    parsed = parse_messages(messages, schemas.UNION_MESSAGE, body)
    r = F.col("record")
    scored = r["ml_prediction"].isNotNull()
    key = r["resource_id"].try_cast("bigint")
    bare = prediction_literal(True, 0.5, fv.DIRECT_REASONING)
    stamp = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    shaped = parsed.withColumn("ml_prediction", r["ml_prediction"]).withColumn("ml_prediction", with_defaults())
    return shaped.select(
        F.col(body).alias("body"),
        F.when(F.col("reason").isNotNull(), F.col("reason")).when(key.isNull(), "bad key").alias("reason"),
        key.alias("resource_id"),
        F.when(scored, r["tender_title"]).otherwise(r["title"]).alias("title"),
        F.coalesce(F.col("ml_prediction"), bare).alias("ml_prediction"),
        F.coalesce(r["pdf_content"], F.lit("")).alias("pdf_content"),
        F.when(scored, r["priority"]).otherwise("NORMAL").alias("priority"),
        F.when(scored, clean.utc_time(r["timestamp"]))
        .otherwise(stamp).alias("timestamp"),
    )


def title_only_message(df: DataFrame, now: Column) -> DataFrame:
    """``df`` plus ``body``: the message that sends a record on without a prediction."""
    return df.withColumn("body", F.to_json(F.struct(
        F.col("resource_id").cast("string").alias("resource_id"), F.col("title").alias("tender_title"),
        prediction_literal(False, 0.0, fv.TITLE_ONLY_REASONING).alias("ml_prediction"),
        F.coalesce("pdf_text", F.lit("")).alias("pdf_content"), F.lit("NORMAL").alias("priority"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
    )))


def scored_message(df: DataFrame, now: Column) -> DataFrame:
    """``df`` plus ``body``: a scored record for the summary stage, urgent when it is a bid."""
    from sievework.operators.scoring import message_priority

    return df.withColumn("body", F.to_json(F.struct(
        F.col("resource_id").cast("string").alias("resource_id"), F.col("title").alias("tender_title"),
        F.struct(
            F.col("ml_bid").alias("should_bid"), F.col("ml_confidence").cast("double").alias("confidence"),
            F.col("ml_reasoning").alias("reasoning"), "feature_scores",
        ).alias("ml_prediction"),
        F.coalesce("pdf_text", F.lit("")).alias("pdf_content"), message_priority("ml_bid").alias("priority"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
    )))
