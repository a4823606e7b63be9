"""Searches, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.adapters import AS_OF
from sievework.catalog.base import DOCS, HITS, NOTICES, RAW_NOTICES, query, with_
from sievework.functions import text
from sievework.operators import scoring, search

FMT = "'%Y-%m-%d %H:%M:%S'"
LISTED_SQL = f"""resource_id, title, ca, strftime(published, {FMT}) AS published, strftime(deadline, {FMT}) AS deadline,
 status, CAST(value AS DOUBLE) AS value"""


@query("search_notices", with_(NOTICES, select=f"""
SELECT {LISTED_SQL}, pdf_url FROM notices
WHERE title ILIKE '%building%' OR ca ILIKE '%building%' OR info ILIKE '%building%'
ORDER BY notices.published DESC NULLS FIRST, resource_id LIMIT 10"""))
def _(t):
    return search.search_notices(t.notices, "building")


@query("search_notices_resource", with_(NOTICES, select=f"""
SELECT {LISTED_SQL}, pdf_url FROM notices
WHERE title ILIKE '%1-URGENT%' OR ca ILIKE '%1-URGENT%' OR info ILIKE '%1-URGENT%'
ORDER BY notices.published DESC NULLS FIRST, resource_id LIMIT 20"""))
def _(t):
    return search.search_notices(t.notices, "1-URGENT", limit=20)


@query("filter_notices", with_(NOTICES, select=f"""
SELECT {LISTED_SQL} FROM notices
WHERE status ILIKE '%open%' AND ca ILIKE '%1%' AND published >= TIMESTAMP '1996-01-01' AND published <= TIMESTAMP '2000-12-31'
 AND deadline >= TIMESTAMP '1996-02-01' AND deadline <= TIMESTAMP '2000-12-31' AND value >= 50000
ORDER BY notices.published DESC NULLS FIRST, resource_id LIMIT 20"""))
def _(t):
    return search.filter_notices(
        t.notices, status="open", contracting_authority="1", published_after="1996-01-01",
        published_before="2000-12-31", deadline_after="1996-02-01", deadline_before="2000-12-31", min_value=50000,
    )


@query("filter_min_value", with_(NOTICES, RAW_NOTICES, select="""
SELECT resource_id, value FROM raw_notices
WHERE value IS NOT NULL AND value <> ''
 AND TRY_CAST(regexp_replace(value, '[^0-9.]', '', 'g') AS DECIMAL(38,10)) >= 100000"""))
def _(t):
    return t.raw_notices.where(search.amount_at_least("value", 100000)).select("resource_id", "value")


@query("find_opportunities", with_(NOTICES, select=f"""
SELECT {LISTED_SQL}, pdf_url, date_diff('day', DATE '2001-07-01', CAST(deadline AS DATE)) AS days_remaining
FROM notices
WHERE (title ILIKE '%urgent%' OR info ILIKE '%urgent%' OR title ILIKE '%machinery%' OR info ILIKE '%machinery%')
 AND status ILIKE '%open%' AND date_diff('day', DATE '2001-07-01', CAST(notices.deadline AS DATE)) >= 7"""))
def _(t):
    return search.find_opportunities(t.notices, ["urgent", "machinery"], "2001-07-01", 7)


@query("find_opportunities_text", with_(NOTICES, select=f"""
SELECT {LISTED_SQL.replace(f"strftime(deadline, {FMT})", "strftime(deadline, '%d/%m/%Y')")}, pdf_url,
 date_diff('day', DATE '2001-07-01', CAST(deadline AS DATE)) AS days_remaining
FROM notices
WHERE (title ILIKE '%auto%' OR info ILIKE '%auto%')
 AND status ILIKE '%open%' AND date_diff('day', DATE '2001-07-01', CAST(notices.deadline AS DATE)) >= 7"""))
def _(t):
    texts = t.notices.withColumn("deadline", F.date_format("deadline", "dd/MM/yyyy"))
    return search.find_opportunities(texts, ["auto"], "2001-07-01", 7)


@query("clean_frame", with_(NOTICES, select="""
SELECT resource_id, title, coalesce(ca, '') AS ca, coalesce(procedure, '') AS procedure,
 coalesce(pdf_url, '') AS pdf_url, CAST(bid AS BIGINT) AS bid
FROM notices WHERE title IS NOT NULL AND bid IS NOT NULL"""))
def _(t):
    return search.clean_frame(t.notices)


@query("clean_frame_with_text", with_(NOTICES, DOCS, HITS, select=f"""
SELECT n.resource_id, title, coalesce(ca, '') AS ca, coalesce(procedure, '') AS procedure,
 coalesce(pdf_url, '') AS pdf_url, CAST(bid AS BIGINT) AS bid, coalesce(c.pdf_text, '') AS pdf_text,
 array_to_string(coalesce(c.detected_codes, CAST([] AS VARCHAR[])), '|') AS detected_codes,
 coalesce(c.codes_count, 0) AS codes_count,
 strftime(published, {FMT}) AS published, strftime(deadline, {FMT}) AS deadline, status, CAST(value AS DOUBLE) AS value
FROM notices n LEFT JOIN coded c ON n.resource_id = c.resource_id WHERE title IS NOT NULL AND bid IS NOT NULL"""))
def _(t):
    return search.clean_frame_with_text(t.notices, t.coded, section_only=False)


@query("modeling_dataset", with_(NOTICES, DOCS, HITS, select=r"""
SELECT n.resource_id, n.title, CAST(bid AS BIGINT) AS bid, codes_count, length(title) AS title_length,
 len(regexp_extract_all(title, '\S+')) AS title_word_count,
 length(pdf_text) AS pdf_text_length, len(regexp_extract_all(pdf_text, '\S+')) AS pdf_text_word_count,
 round(length(pdf_text)::DOUBLE / (length(title) + 1), 14) AS pdf_to_title_ratio,
 round(codes_count::DOUBLE / (length(pdf_text) / 1000.0 + 1), 14) AS code_density,
 CASE WHEN pdf_url <> '' THEN 1 ELSE 0 END AS has_pdf, 1 AS has_pdf_content,
 CASE WHEN codes_count > 0 THEN 1 ELSE 0 END AS has_codes
FROM notices n JOIN coded c ON n.resource_id = c.resource_id
WHERE bid IS NOT NULL AND length(trim(pdf_text)) > 0 AND length(pdf_text) >= 50"""))
def _(t):
    df = search.modeling_dataset(t.notices, t.coded, section_only=False, min_text_length=50)
    return df.drop("ca", "procedure", "pdf_url", "pdf_text", "detected_codes", *search.OPTIONAL)


@query("has_text_filter", with_(DOCS, select="""
SELECT resource_id FROM doc_content WHERE pdf_text IS NOT NULL AND length(trim(pdf_text, E' \\t\\n\\r')) > 0"""))
def _(t):
    return search.has_text(t.doc_content).select("resource_id")


@query("drop_columns", with_(NOTICES, select="""
SELECT resource_id, title, ca, status, procedure, pdf_url, bid FROM notices"""))
def _(t):
    unused = ["info", "published", "deadline", "created_at", "awarddate", "value", "cycle", "no_such_column"]
    return search.drop_columns(t.notices, unused)


@query("recent_activity", with_(DOCS, select=f"""
SELECT resource_id, length(pdf_text) AS text_length, processing_status,
 strftime(extraction_timestamp, {FMT}) AS extraction_timestamp
FROM doc_content WHERE doc_content.extraction_timestamp >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 24 HOURS"""))
def _(t):
    docs = search.recent(t.doc_content, "extraction_timestamp", AS_OF, "24 HOURS")
    return docs.select("resource_id", F.length("pdf_text").alias("text_length"), "processing_status", "extraction_timestamp")


@query("notices_of_day", with_(NOTICES, select=f"""
SELECT {LISTED_SQL} FROM notices WHERE CAST(created_at AS DATE) = DATE '2001-08-01'"""))
def _(t):
    return search.on_day(t.notices, "created_at", "2001-08-01").select(*search.LISTED)


@query("recent_notices", with_(NOTICES, select=f"""
SELECT {LISTED_SQL} FROM notices ORDER BY created_at DESC NULLS FIRST, resource_id LIMIT 10"""))
def _(t):
    return search.newest(t.notices, "created_at", 10).select(*search.LISTED)


@query("notified_notices", with_(NOTICES, select=f"""
SELECT resource_id, title, strftime(deadline, {FMT}) AS notification_sent_at FROM notices
WHERE status = 'Open' ORDER BY notices.deadline DESC NULLS FIRST, resource_id LIMIT 20"""))
def _(t):
    marked = t.notices.withColumns({
        "notification_sent": F.col("status") == "Open", "notification_sent_at": F.col("deadline"),
    })
    return search.notified(marked).select("resource_id", "title", "notification_sent_at")


@query("sample_rows", with_(NOTICES, select="""
SELECT resource_id, title FROM notices ORDER BY md5(concat('42:', CAST(resource_id AS VARCHAR))), resource_id LIMIT 100"""))
def _(t):
    return search.sample_rows(t.notices, 100).select("resource_id", "title")


@query("score_guard", with_(NOTICES, DOCS, select="""
SELECT n.resource_id, d.pdf_text IS NOT NULL AND length(trim(d.pdf_text)) > 0 AS is_scored,
 CASE WHEN d.pdf_text IS NULL OR length(trim(d.pdf_text)) = 0 THEN 'routing_error' END AS problem,
 CASE WHEN d.pdf_text IS NULL OR length(trim(d.pdf_text)) = 0 THEN 0.0::DOUBLE END AS confidence
FROM notices n LEFT JOIN doc_content d USING (resource_id)"""))
def _(t):
    rows = t.notices.join(text.text_sizes(t.doc_content), "resource_id", "left").withColumn("codes_count", F.lit(0))
    scored = scoring.decide(*_guarded(rows))
    guarded = F.col("ml_status") == "routing_error"
    return scored.select(
        "resource_id", (~guarded).alias("is_scored"), F.when(guarded, F.col("ml_status")).alias("problem"),
        F.when(guarded, F.col("ml_confidence")).alias("confidence"),
    )


def _guarded(rows):
    """The guard needs no features: all 15 set to 0."""
    names = scoring.feature_names(scoring.Lexicon())
    return rows.drop("codes_count").withColumns({n: F.lit(0.0) for n in names}), names


@query("distinct_values", with_(NOTICES, select="""
SELECT DISTINCT procedure FROM notices WHERE procedure IS NOT NULL ORDER BY procedure LIMIT 10"""))
def _(t):
    return search.distinct_values(t.notices, "procedure")


@query("next_unlabelled", with_(NOTICES, select="""
SELECT resource_id, concat('Title ', title) AS title, ca, coalesce(info, '') AS info
FROM notices WHERE bid IS NULL ORDER BY resource_id LIMIT 5"""))
def _(t):
    tagged = t.notices.withColumns({
        "title": F.concat(F.lit(" <b>Title</b> "), "title", F.lit("<br")), "ca": F.concat(F.lit("<i class='x'>"), "ca", F.lit("</i>")),
        "info": F.concat(F.lit("<p>"), F.coalesce("info", F.lit("")), F.lit("</p>> ")),
    })
    return search.next_unlabelled(tagged, 5)


@query("get_notice", with_(NOTICES, select=f"""
SELECT {LISTED_SQL}, info, procedure, pdf_url, bid FROM notices WHERE resource_id = 77"""))
def _(t):
    return search.get_notice(t.notices, 77).select(*search.LISTED, "info", "procedure", "pdf_url", "bid")


@query("get_record", with_(NOTICES, select=f"""
SELECT resource_id, title, ca AS contracting_authority, status FROM notices WHERE resource_id = 77"""))
def _(t):
    return search.get_record(t.notices, 77).select("resource_id", "title", "contracting_authority", "status")


@query("get_doc_content", with_(DOCS, HITS, select="""
SELECT resource_id, pdf_text, array_to_string(detected_codes, '|') AS detected_codes, codes_count
FROM coded WHERE resource_id = 11"""))
def _(t):
    return search.get_doc_content(t.coded, 11).select("resource_id", "pdf_text", "detected_codes", "codes_count")
