"""Joins (J01-J05, J07) and the scans that join."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.catalog.base import DOCS, HITS, NOTICES, query, with_
from sievework.operators import joins, search, upsert

FMT = "'%Y-%m-%d %H:%M:%S'"


@query("join_left_text", with_(NOTICES, DOCS, select="""
SELECT n.resource_id, n.title, coalesce(d.pdf_text, '') AS pdf_text, d.processing_status
FROM notices n LEFT JOIN doc_content d ON n.resource_id = d.resource_id"""))
def _(t):
    texts = t.doc_content.withColumn("resource_id", F.col("resource_id").cast("string"))
    joined = search.scan_notices_with_text(t.notices, texts)
    return joined.select("resource_id", "title", "pdf_text", "processing_status")


@query("join_failures", with_(NOTICES, DOCS, select=f"""
SELECT n.resource_id, n.title, n.ca, n.pdf_url, d.processing_status,
 strftime(d.extraction_timestamp, {FMT}) AS extraction_timestamp, d.pdf_text
FROM notices n JOIN doc_content d USING (resource_id)
WHERE d.processing_status = 'failed' AND n.published >= TIMESTAMP '1996-06-19'"""))
def _(t):
    return joins.failed_documents(t.notices, t.doc_content, "1996-06-19")


@query("pending_documents", with_(NOTICES, DOCS, select=f"""
SELECT n.resource_id, n.title, n.ca, n.pdf_url, strftime(n.published, {FMT}) AS published,
 strftime(n.deadline, {FMT}) AS deadline
FROM notices n LEFT JOIN doc_content d USING (resource_id)
WHERE n.pdf_url IS NOT NULL AND n.pdf_url <> '' AND d.resource_id IS NULL AND n.published >= TIMESTAMP '1996-06-19'
ORDER BY n.published DESC NULLS FIRST, n.resource_id LIMIT 20"""))
def _(t):
    return joins.pending_documents(t.notices, t.doc_content, "1996-06-19")


@query("filter_new_records", with_(NOTICES, DOCS, select="""
SELECT resource_id, title FROM notices WHERE resource_id NOT IN (SELECT resource_id FROM doc_content)"""))
def _(t):
    return upsert.filter_new_records(t.notices.select("resource_id", "title"), t.doc_content)


@query("pending_count", with_(NOTICES, DOCS, select="""
SELECT count(CASE WHEN pdf_url <> '' AND NOT EXISTS
  (SELECT 1 FROM doc_content d WHERE d.resource_id = notices.resource_id) THEN 1 END) AS pending
FROM notices"""))
def _(t):
    return joins.pending_count(t.notices, t.doc_content)


@query("enrich_messages", with_(NOTICES, DOCS, HITS, """
messages AS (SELECT o_orderkey AS resource_id, CASE
  WHEN o_orderkey % 3 = 0 THEN 'short' WHEN o_orderkey % 3 = 1 THEN repeat('middling text ', 20)
  ELSE repeat('a long text of its own ', 60) END AS pdf_content FROM orders
 UNION ALL SELECT -1 - c_custkey, 'short' FROM customer)""", select="""
SELECT m.resource_id, n.title,
 CASE WHEN strlen(m.pdf_content) < 100 THEN 'TITLE_ONLY' ELSE 'FULL_PDF' END AS summary_type,
 CASE WHEN strlen(m.pdf_content) < 100 THEN 'none' WHEN strlen(m.pdf_content) <= 1000 THEN 'store' ELSE 'message' END AS text_source,
 CASE WHEN strlen(m.pdf_content) < 100 THEN '' WHEN strlen(m.pdf_content) <= 1000 THEN c.pdf_text ELSE m.pdf_content END AS pdf_text,
 coalesce(c.codes_count, 0) AS codes_count,
 CASE WHEN n.resource_id IS NULL THEN 'notice not found'
  WHEN strlen(m.pdf_content) BETWEEN 100 AND 1000 AND c.resource_id IS NULL THEN 'text not found' END AS problem
FROM messages m LEFT JOIN notices n USING (resource_id) LEFT JOIN coded c ON m.resource_id = c.resource_id"""))
def _(t):
    key = F.col("resource_id")
    known = t.raw("orders").select(
        F.col("o_orderkey").alias("resource_id"),
        F.when(F.col("o_orderkey") % 3 == 0, "short")
        .when(F.col("o_orderkey") % 3 == 1, F.repeat(F.lit("middling text "), 20))
        .otherwise(F.repeat(F.lit("a long text of its own "), 60)).alias("pdf_content"),
    )
    unknown = t.raw("customer").select((-1 - F.col("c_custkey")).alias("resource_id"), F.lit("short").alias("pdf_content"))
    rows = joins.enrich_messages(known.unionByName(unknown), t.notices, t.coded)
    return rows.select(key, "title", "summary_type", "text_source", "pdf_text", "codes_count", "problem")
