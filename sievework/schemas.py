"""Declared schemas of the stored tables and messages, and schema alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOTICES = T.StructType([
    T.StructField("resource_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("ca", T.StringType()),
    T.StructField("info", T.StringType()),
    T.StructField("published", T.TimestampNTZType()),
    T.StructField("deadline", T.TimestampNTZType()),
    T.StructField("procedure", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("pdf_url", T.StringType()),
    T.StructField("awarddate", T.DateType()),
    T.StructField("value", T.DecimalType(15, 2)),
    T.StructField("cycle", T.StringType()),
    T.StructField("bid", T.IntegerType()),
    T.StructField("notification_sent", T.BooleanType()),
    T.StructField("notification_sent_at", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("ml_processed", T.BooleanType()),
    T.StructField("ml_bid", T.BooleanType()),
    T.StructField("ml_confidence", T.DecimalType(5, 4)),
    T.StructField("ml_reasoning", T.StringType()),
    T.StructField("ml_status", T.StringType()),
])

# What the store fills in for a column that an older table does not have.
NOTICE_DEFAULTS: dict[str, object] = {
    "notification_sent": False,
    "ml_processed": False,
    "ml_status": "pending",
}

DOC_CONTENT = T.StructType([
    T.StructField("resource_id", T.LongType(), False),
    T.StructField("pdf_text", T.StringType()),
    T.StructField("extraction_timestamp", T.TimestampNTZType()),
    T.StructField("processing_status", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("detected_codes", T.ArrayType(T.StringType())),
    T.StructField("codes_count", T.IntegerType()),
])

DOC_CONTENT_DEFAULTS: dict[str, object] = {"metadata": "{}", "codes_count": 0}

SUMMARIES = T.StructType([
    T.StructField("resource_id", T.LongType(), False),
    T.StructField("summary_type", T.StringType()),
    T.StructField("ai_summary", T.StringType()),
    T.StructField("key_points", T.ArrayType(T.StringType())),
    T.StructField("recommendation", T.StringType()),
    T.StructField("confidence_assessment", T.StringType()),
    T.StructField("processing_notes", T.ArrayType(T.StringType())),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

# A scraped row before typing: every field is text.
RAW_NOTICES = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "title", "resource_id", "ca", "info", "published", "deadline", "procedure",
        "status", "pdf_url", "awarddate", "value", "cycle",
    )
])

COMPONENT_SCORES = T.StructType([
    T.StructField(name, T.DoubleType())
    for name in (
        "codes_count_score", "has_codes_score", "title_length_score", "ca_score",
        "text_features_score", "total_score",
    )
])

PREDICTION = T.StructType([
    T.StructField("should_bid", T.BooleanType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("feature_scores", COMPONENT_SCORES),
])

# Superset of the scored message and the bare record. ``resource_id`` is a string in the one and
# a number in the other; read as text it covers both.
UNION_MESSAGE = T.StructType([
    T.StructField("resource_id", T.StringType()),
    T.StructField("tender_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("ml_prediction", PREDICTION),
    T.StructField("pdf_content", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

NOTIFICATION = T.StructType([
    T.StructField("message_type", T.StringType()),
    T.StructField("resource_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("action_required", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("metadata", T.StringType()),
])


def default_column(field: T.StructField, defaults: dict[str, object]) -> Column:
    value = defaults.get(field.name)
    if isinstance(field.dataType, T.ArrayType) and value is None:
        return F.array().cast(field.dataType)
    return F.lit(value).cast(field.dataType)


def align_schema(df: DataFrame, target: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Give ``df`` every column of ``target``: present ones are cast, missing ones get their default.

    Columns that the target does not know are kept at the end, so running it twice changes nothing.
    """
    defaults = defaults or {}
    known = [
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
        else default_column(f, defaults).alias(f.name)
        for f in target.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in target.names]
    return df.select(*known, *extra)
