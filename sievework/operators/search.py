"""Searches, filters, look-ups and modelling projections over the notice table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.clean import is_blank, min_value as amount_at_least, strip_html
from sievework.functions.text import extract_section, presence_flags, text_features

LISTED = ("resource_id", "title", "ca", "published", "deadline", "status", "value")


def newest_first(column: str, key: str = "resource_id") -> list[Column]:
    """Descending with NULLs first, as the store sorts, with the key as tie-break."""
    return [F.col(column).desc_nulls_first(), F.col(key).asc()]


def _like(column: str, text: str) -> Column:
    """Case-insensitive substring; ``%`` and ``_`` in the text are wildcards."""
    return F.col(column).ilike(f"%{text}%")


def search_notices(notices: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """Keyword in title, authority or info; newest first."""
    hit = _like("title", query) | _like("ca", query) | _like("info", query)
    return notices.where(hit).orderBy(*newest_first("published")).limit(limit).select(*LISTED, "pdf_url")


def filter_notices(
    notices: DataFrame,
    status: str | None = None,
    contracting_authority: str | None = None,
    published_after: str | None = None,
    published_before: str | None = None,
    deadline_after: str | None = None,
    deadline_before: str | None = None,
    min_value: float | None = None,
    limit: int = 20,
) -> DataFrame:
    """Every argument given adds a condition; newest first."""
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    conditions = [
        _like("status", status) if status else None,
        _like("ca", contracting_authority) if contracting_authority else None,
        F.col("published") >= stamp(published_after) if published_after else None,
        F.col("published") <= stamp(published_before) if published_before else None,
        F.col("deadline") >= stamp(deadline_after) if deadline_after else None,
        F.col("deadline") <= stamp(deadline_before) if deadline_before else None,
    ]
    if min_value:
        text_amount = dict(notices.dtypes)["value"] == "string"
        conditions.append(amount_at_least("value", min_value) if text_amount else F.col("value") >= F.lit(min_value))
    wanted = reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))
    return notices.where(wanted).orderBy(*newest_first("published")).limit(limit).select(*LISTED)


def find_opportunities(
    notices: DataFrame, keywords: Sequence[str], as_of: str, min_days_remaining: int = 7
) -> DataFrame:
    """Open notices with a keyword and enough days left; ``as_of`` is today's date.

    A text deadline must be ``dd/MM/yyyy``; a typed one is used as it is.
    """
    hit = reduce(lambda a, b: a | b, [_like("title", k) | _like("info", k) for k in keywords], F.lit(False))
    if dict(notices.dtypes)["deadline"] == "string":
        parts = [F.substring("deadline", 7, 4), F.substring("deadline", 4, 2), F.substring("deadline", 1, 2)]
        due = F.when(
            F.col("deadline").rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.concat_ws("-", *parts).try_cast("date")
        )
    else:
        due = F.col("deadline").cast("date")
    open_ones = notices.where(hit & _like("status", "open"))
    dated = open_ones.withColumn("days_remaining", F.date_diff(due, F.lit(as_of).cast("date")))
    return (
        dated.where(F.col("days_remaining") >= min_days_remaining)
        .select(*LISTED, "pdf_url", "days_remaining")
        .orderBy(F.col("days_remaining").asc(), F.col("resource_id").asc())
    )


def recent(df: DataFrame, column: str, as_of: str, interval: str) -> DataFrame:
    """Rows of the last ``interval`` (for example ``24 HOURS``) before ``as_of`` (P10)."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(column) >= since)


def on_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one calendar day, as a range that reaches the scan."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.where((F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY")))


def newest(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    return df.orderBy(*newest_first(column)).limit(limit)


def notified(notices: DataFrame, limit: int = 20) -> DataFrame:
    """Notified notices, last sent first."""
    return newest(notices.where(F.col("notification_sent")), "notification_sent_at", limit)


def get_notice(notices: DataFrame, resource_id: int) -> DataFrame:
    return notices.where(F.col("resource_id") == resource_id)


def get_record(notices: DataFrame, resource_id: int) -> DataFrame:
    """Point look-up under the names the scorer uses."""
    return get_notice(notices, resource_id).withColumnRenamed("ca", "contracting_authority")


def get_doc_content(doc_content: DataFrame, resource_id: int) -> DataFrame:
    """Point look-up of a text; missing codes become an empty list and 0."""
    return get_notice(doc_content, resource_id).withColumns({
        "detected_codes": F.coalesce(F.col("detected_codes"), F.array().cast("array<string>")),
        "codes_count": F.coalesce(F.col("codes_count"), F.lit(0)),
    })


def next_unlabelled(notices: DataFrame, n: int = 1) -> DataFrame:
    """The next rows to label, tags removed from their texts."""
    rows = notices.where(F.col("bid").isNull()).orderBy("resource_id").limit(n)
    return rows.select("resource_id", *[strip_html(c).alias(c) for c in ("title", "ca", "info")])


def clean_frame(notices: DataFrame, labelled_only: bool = True) -> DataFrame:
    """Modelling columns: no missing titles, "" for missing categories."""
    kept = notices.where(F.col("title").isNotNull())
    if labelled_only:
        kept = kept.where(F.col("bid").isNotNull())
    return kept.select(
        "resource_id", "title",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("ca", "procedure", "pdf_url")],
        F.col("bid").cast("int").alias("bid"),
    )


OPTIONAL = ("published", "deadline", "status", "value")


def scan_notices_with_text(
    notices: DataFrame,
    doc_content: DataFrame,
    include_unlabelled: bool = True,
    section_only: bool = False,
    with_text_only: bool = False,
) -> DataFrame:
    """Notices with their document text, missing values filled."""
    left = notices if include_unlabelled else notices.where(F.col("bid").isNotNull())
    wanted = [c for c in ("pdf_text", "detected_codes", "codes_count", "extraction_timestamp", "processing_status")
              if c in doc_content.columns]
    right = doc_content.select(F.col("resource_id").cast("bigint").alias("resource_id"), *wanted)
    if with_text_only:
        right = has_text(right)
    joined = left.join(right, "resource_id", "inner" if with_text_only else "left")
    text = extract_section("pdf_text") if section_only else F.coalesce(F.col("pdf_text"), F.lit(""))
    fills = {"pdf_text": text}
    if "codes_count" in wanted:
        fills["codes_count"] = F.coalesce(F.col("codes_count"), F.lit(0))
    if "detected_codes" in wanted:
        fills["detected_codes"] = F.coalesce(F.col("detected_codes"), F.array().cast("array<string>"))
    return joined.withColumns(fills)


def has_text(df: DataFrame, column: str = "pdf_text") -> DataFrame:
    """Rows whose text is more than white space."""
    return df.where(~is_blank(column))


def clean_frame_with_text(
    notices: DataFrame, doc_content: DataFrame, labelled_only: bool = True, section_only: bool = True,
    with_text_only: bool = False,
) -> DataFrame:
    """P05 with text, codes and whatever optional columns exist."""
    df = scan_notices_with_text(notices, doc_content, not labelled_only, section_only, with_text_only)
    keep = [c for c in OPTIONAL if c in df.columns]
    kept = df.where(F.col("title").isNotNull())
    if labelled_only:
        kept = kept.where(F.col("bid").isNotNull())
    return kept.select(
        "resource_id", "title",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("ca", "procedure", "pdf_url")],
        F.col("bid").cast("int").alias("bid"),
        "pdf_text", "detected_codes", "codes_count", *keep,
    )


def modeling_dataset(
    notices: DataFrame, doc_content: DataFrame, labelled_only: bool = True, section_only: bool = True,
    min_text_length: int = 10, min_codes: int = 0, with_text_only: bool = True,
) -> DataFrame:
    """P06 with features, flags and the quality filter."""
    df = presence_flags(text_features(
        clean_frame_with_text(notices, doc_content, labelled_only, section_only, with_text_only)
    ))
    if min_text_length > 0:
        df = df.where(F.col("pdf_text_length") >= min_text_length)
    if min_codes > 0:
        df = df.where(F.col("codes_count") >= min_codes)
    return df.where(~is_blank("title"))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop what is there of ``columns``."""
    return df.drop(*columns)


def sample_rows(df: DataFrame, n: int, key: str = "resource_id", seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows: those whose seeded digest comes first."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(n)


def distinct_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Up to ``n`` distinct values, smallest first so that the answer repeats."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(n)
