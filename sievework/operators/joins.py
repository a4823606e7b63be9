"""Joins of notices, texts and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.search import newest_first


def has_url(column: str = "pdf_url") -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


def failed_documents(notices: DataFrame, doc_content: DataFrame, since: str, failed: str = "failed") -> DataFrame:
    """Notices whose text failed, newest first."""
    texts = doc_content.where(F.col("processing_status") == failed)
    recent = notices.where(F.col("published") >= F.lit(since).cast("timestamp_ntz"))
    columns = ["resource_id", "title", "ca", "pdf_url", "processing_status", "extraction_timestamp", "pdf_text"]
    return recent.join(texts, "resource_id").select(*columns).orderBy(*newest_first("extraction_timestamp"))


def pending_documents(notices: DataFrame, doc_content: DataFrame, since: str, limit: int | None = 20) -> DataFrame:
    """Notices with a URL and no text yet, newest first."""
    waiting = notices.where(has_url() & (F.col("published") >= F.lit(since).cast("timestamp_ntz")))
    waiting = waiting.join(doc_content.select("resource_id"), "resource_id", "left_anti")
    rows = waiting.select("resource_id", "title", "ca", "pdf_url", "published", "deadline")
    rows = rows.orderBy(*newest_first("published"))
    return rows if limit is None else rows.limit(limit)


def mark_processed(notices: DataFrame, doc_content: DataFrame) -> DataFrame:
    """``has_doc``: whether a text row exists. The key side is made distinct, so no row repeats."""
    keys = doc_content.select("resource_id").distinct().withColumn("has_doc", F.lit(True))
    return notices.join(keys, "resource_id", "left").withColumn("has_doc", F.coalesce("has_doc", F.lit(False)))


def pending_count(notices: DataFrame, doc_content: DataFrame) -> DataFrame:
    """How many notices have a URL and no text."""
    marked = mark_processed(notices.select("resource_id", "pdf_url"), doc_content)
    return marked.agg(F.count_if(has_url() & ~F.col("has_doc")).alias("pending"))


def enrich_messages(
    messages: DataFrame, notices: DataFrame, doc_content: DataFrame, short: int = 100, own_text: int = 1000
) -> DataFrame:
    """Messages with their notice and text.

    Texts under ``short`` bytes mean a title-only summary; over ``own_text`` bytes the message
    text is used, in between the stored one is fetched. Codes come from the store.
    ``problem`` names rows that cannot go on: no such notice, or no stored text.
    """
    stored = doc_content.select(
        "resource_id", F.col("pdf_text").alias("_stored"), "detected_codes", "codes_count",
        F.lit(True).alias("_has_doc"),
    )
    known = notices.drop("pdf_content", "detected_codes", "codes_count").withColumn("_has_notice", F.lit(True))
    joined = messages.join(known, "resource_id", "left").join(stored, "resource_id", "left")
    size = F.octet_length(F.coalesce(F.col("pdf_content"), F.lit("")))
    fetch = size.between(short, own_text)
    return joined.withColumns({
        "summary_type": F.when(size < short, "TITLE_ONLY").otherwise("FULL_PDF"),
        "text_source": F.when(size < short, "none").when(fetch, "store").otherwise("message"),
        "pdf_text": F.when(size < short, F.lit("")).when(fetch, F.col("_stored")).otherwise(F.col("pdf_content")),
        "detected_codes": F.coalesce(F.col("detected_codes"), F.array().cast("array<string>")),
        "codes_count": F.coalesce(F.col("codes_count"), F.lit(0)),
        "problem": F.when(F.col("_has_notice").isNull(), "notice not found")
        .when(fetch & F.col("_has_doc").isNull(), "text not found"),
    }).drop("_stored", "_has_doc", "_has_notice")
