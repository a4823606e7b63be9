"""Counts, shares and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.adapters import AS_OF, EVENTS_AS_OF
from sievework.catalog.base import DOCS, HITS, NOTICES, query, with_
from sievework.operators import joins, monitor, search
from sievework.functions import text
from sievework.functions.text import presence_flags, text_features, text_measures, word_tokens

FMT = "'%Y-%m-%d %H:%M:%S'"
SINCE = "1996-06-19"
STATUS_SQL = """CASE WHEN n.pdf_url IS NULL OR n.pdf_url = '' THEN 'No PDF URL'
 WHEN d.resource_id IS NULL THEN 'PDF Not Processed'
 WHEN d.processing_status = 'COMPLETED' THEN 'Successfully Processed'
 WHEN d.processing_status = 'failed' THEN 'Processing Failed'
 ELSE coalesce(d.processing_status, 'Unknown') END"""


@query("count_by_label", with_(NOTICES, select="""
SELECT CAST(bid AS BIGINT) AS bid, count(*) AS n FROM notices WHERE bid IS NOT NULL GROUP BY 1"""))
def _(t):
    return monitor.count_by_label(t.notices)


@query("doc_status_summary", with_(DOCS, select=f"""
SELECT count(*) AS total_records, count(CASE WHEN processing_status = 'COMPLETED' THEN 1 END) AS completed_records,
 strftime(max(extraction_timestamp), {FMT}) AS latest_extraction,
 count(CASE WHEN extraction_timestamp >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 1 HOUR THEN 1 END) AS processed_last_hour
FROM doc_content"""))
def _(t):
    return monitor.doc_status_summary(t.doc_content, AS_OF)


@query("url_availability", with_(NOTICES, select="""
SELECT count(*) AS total, count(CASE WHEN pdf_url <> '' THEN 1 END) AS with_url,
 count(CASE WHEN pdf_url IS NULL OR pdf_url = '' THEN 1 END) AS without_url,
 CAST(round(count(CASE WHEN pdf_url <> '' THEN 1 END) * 100.0 / count(*), 2) AS DOUBLE) AS availability_pct FROM notices"""))
def _(t):
    return monitor.url_availability(t.notices)


def _predicted(t):
    """Notices with prediction columns that follow from their value."""
    high = F.col("value") >= 100000
    return t.notices.withColumns({
        "awarddate": F.when(F.col("status") == "Awarded", F.col("published").cast("date")),
        "ml_processed": F.col("value").isNotNull(),
        "ml_bid": high,
        "ml_status": F.when(high, "bid").when(~high, "no-bid").otherwise("pending"),
        "notification_sent": F.when(F.col("value").isNotNull(), high),
        "probability": F.col("value").cast("double") / F.lit(1000000.0),
    })


@query("migration_audit", with_(NOTICES, select="""
SELECT count(*) AS total_records, count(published) AS published_dates, count(deadline) AS deadline_dates,
 count(CASE WHEN status = 'Awarded' THEN 1 END) AS award_dates, count(value) AS valid_values, count(bid) AS labelled_records,
 count(*) AS ml_processed_count, count(value) AS ml_predicted_count, round(CAST(sum(value) AS DOUBLE) / count(value), 4) AS avg_value,
 CAST(max(value) AS DOUBLE) AS max_value, count(CASE WHEN bid = 1 THEN 1 END) AS positive_labels,
 count(CASE WHEN bid = 0 THEN 1 END) AS negative_labels,
 count(CASE WHEN value >= 100000 THEN 1 END) AS ml_positive_predictions,
 count(CASE WHEN value < 100000 THEN 1 END) AS ml_negative_predictions,
 count(value) AS ml_processed_records, count(CASE WHEN value >= 100000 THEN 1 END) AS bid_status_count,
 count(CASE WHEN value < 100000 THEN 1 END) AS no_bid_status_count,
 count(CASE WHEN value IS NULL THEN 1 END) AS pending_status_count FROM notices"""))
def _(t):
    return monitor.migration_audit(_predicted(t)).withColumn("avg_value", F.round("avg_value", 4))


@query("notification_totals", with_(NOTICES, select="""
SELECT count(*) AS total, count(CASE WHEN value >= 100000 THEN 1 END) AS notified,
 count(CASE WHEN value IS NULL OR value < 100000 THEN 1 END) AS pending FROM notices"""))
def _(t):
    return monitor.notification_totals(_predicted(t))


@query("notice_statistics", with_(NOTICES, select="""
SELECT count(*) AS total, count(CASE WHEN status ILIKE '%open%' THEN 1 END) AS open,
 count(CASE WHEN status ILIKE '%closed%' THEN 1 END) AS closed,
 count(CASE WHEN published >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAYS THEN 1 END) AS recent FROM notices"""))
def _(t):
    return monitor.notice_statistics(t.notices, AS_OF)


@query("top_authorities", with_(NOTICES, select="""
SELECT ca, count(*) AS n FROM notices GROUP BY ca ORDER BY n DESC, ca LIMIT 10"""))
def _(t):
    return monitor.counts_desc(t.notices, "ca", 10)


@query("status_counts", with_(NOTICES, select="""
SELECT status, count(*) AS n FROM notices GROUP BY status ORDER BY n DESC"""))
def _(t):
    return monitor.counts_desc(t.notices, "status")


@query("doc_status_rows", with_(NOTICES, DOCS, select=f"""
SELECT n.resource_id, n.title, n.ca, strftime(n.published, {FMT}) AS published, strftime(n.deadline, {FMT}) AS deadline,
 {STATUS_SQL} AS doc_status, strftime(d.extraction_timestamp, {FMT}) AS extraction_timestamp, length(d.pdf_text) AS text_length
FROM notices n LEFT JOIN doc_content d ON n.resource_id = d.resource_id WHERE n.published >= TIMESTAMP '{SINCE}'"""))
def _(t):
    return monitor.doc_status_rows(t.notices, t.doc_content, SINCE)


@query("status_funnel", with_(NOTICES, DOCS, select=f"""
SELECT {STATUS_SQL} AS status, count(*) AS n,
 CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS percentage
FROM notices n LEFT JOIN doc_content d ON n.resource_id = d.resource_id WHERE n.published >= TIMESTAMP '{SINCE}' GROUP BY 1"""))
def _(t):
    return monitor.status_funnel(t.notices, t.doc_content, SINCE)


@query("hourly_activity", f"""
SELECT strftime(date_trunc('hour', ts), {FMT}) AS hour, count(*) AS processed,
 count(CASE WHEN event_type = 'purchase' THEN 1 END) AS successful, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed
FROM events GROUP BY 1""")
def _(t):
    kind = F.col("event_type")
    return monitor.hourly_activity(t.raw("events"), "ts", kind == "purchase", kind == "error")


@query("hourly_activity_day", f"""
SELECT strftime(date_trunc('hour', ts), {FMT}) AS hour, count(*) AS processed,
 count(CASE WHEN event_type = 'purchase' THEN 1 END) AS successful, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed
FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOURS GROUP BY 1""")
def _(t):
    kind = F.col("event_type")
    since = F.lit(EVENTS_AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS")
    return monitor.hourly_activity(t.raw("events"), "ts", kind == "purchase", kind == "error", since)


@query("authority_rate", with_(NOTICES, DOCS, select=f"""
SELECT n.ca, count(*) AS total, count(CASE WHEN n.pdf_url <> '' THEN 1 END) AS with_url, count(d.resource_id) AS processed,
 CAST(round(count(d.resource_id) * 100.0 / nullif(count(CASE WHEN n.pdf_url <> '' THEN 1 END), 0), 2) AS DOUBLE) AS rate_pct
FROM notices n LEFT JOIN doc_content d ON n.resource_id = d.resource_id WHERE n.published >= TIMESTAMP '{SINCE}'
GROUP BY n.ca HAVING count(*) > 1"""))
def _(t):
    return monitor.authority_rate(t.notices, t.doc_content, SINCE)


@query("load_checkpoint", with_(NOTICES, DOCS, select=f"""
SELECT 'Before Dataload' AS checkpoint, count(*) AS total_records, strftime(max(published), {FMT}) AS latest_published,
 count(CASE WHEN pdf_url <> '' THEN 1 END) AS records_with_url,
 count(CASE WHEN pdf_url <> '' AND NOT EXISTS (SELECT 1 FROM doc_content d WHERE d.resource_id = notices.resource_id) THEN 1 END) AS pending_documents
FROM notices"""))
def _(t):
    return monitor.load_checkpoint(t.notices, t.doc_content)


@query("daily_counts", f"""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT user_id) AS n_keys
FROM events WHERE ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAYS GROUP BY 1""")
def _(t):
    since = F.lit(EVENTS_AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    return monitor.daily_counts(t.raw("events"), "ts", "user_id", since)


@query("flag_counts", with_(NOTICES, select="""
SELECT pdf_url <> '' AS flag, count(*) AS n FROM notices
WHERE created_at >= TIMESTAMP '2001-08-01' - INTERVAL 720 HOURS GROUP BY 1"""))
def _(t):
    return monitor.flag_counts(search.recent(t.notices, "created_at", AS_OF, "720 HOURS"), joins.has_url())


@query("prediction_stats", with_(NOTICES, select="""
SELECT count(*) AS total, count(value) AS predicted, round(avg(CAST(value AS DOUBLE) / 1000000.0), 14) AS avg_probability FROM notices"""))
def _(t):
    return monitor.prediction_stats(_predicted(t), "probability")


@query("duplicate_keys", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def _(t):
    return monitor.duplicate_keys(t.raw("lineitem"), "l_orderkey")


@query("available_codes", with_(DOCS, HITS, select="SELECT DISTINCT unnest(detected_codes) AS code FROM coded"))
def _(t):
    return monitor.available_codes(t.coded)


CODE_COUNTS = "code_counts AS (SELECT code, count(*) AS n FROM (SELECT unnest(detected_codes) AS code FROM coded) GROUP BY 1)"


@query("code_statistics", with_(DOCS, HITS, CODE_COUNTS, select="""
SELECT code, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM coded), 14) AS percentage FROM code_counts"""))
def _(t):
    return monitor.code_statistics(t.coded)


@query("frequency_bands", with_("""counts AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""", select="""
SELECT CASE WHEN n = 1 THEN '1' WHEN n BETWEEN 2 AND 5 THEN '2-5' WHEN n BETWEEN 6 AND 20 THEN '6-20'
 WHEN n BETWEEN 21 AND 100 THEN '21-100' ELSE '101+' END AS band, count(*) AS n_codes FROM counts GROUP BY 1"""))
def _(t):
    return monitor.frequency_bands(monitor.value_counts(t.raw("events"), "user_id"))


@query("code_frequency_bands", with_(DOCS, HITS, CODE_COUNTS, select="""
SELECT CASE WHEN n = 1 THEN '1' WHEN n BETWEEN 2 AND 5 THEN '2-5' WHEN n BETWEEN 6 AND 20 THEN '6-20'
 WHEN n BETWEEN 21 AND 100 THEN '21-100' ELSE '101+' END AS band, count(*) AS n_codes FROM code_counts GROUP BY 1"""))
def _(t):
    return monitor.frequency_bands(monitor.code_statistics(t.coded))


@query("code_sparsity", with_(DOCS, HITS, CODE_COUNTS, select="""
SELECT n_rows, n_set, round(avg_codes, 14) AS avg_codes, n_codes, round(n_set::DOUBLE / nullif(n_rows * n_codes, 0), 14) AS density,
 round(1.0::DOUBLE - n_set::DOUBLE / nullif(n_rows * n_codes, 0), 14) AS sparsity
FROM (SELECT count(*) AS n_rows, CAST(sum(codes_count) AS BIGINT) AS n_set, avg(codes_count) AS avg_codes FROM coded),
 (SELECT count(*) AS n_codes FROM code_counts)"""))
def _(t):
    return monitor.code_sparsity(t.coded)


TOP = """top AS (SELECT code, row_number() OVER (ORDER BY n DESC, code) AS r FROM code_counts ORDER BY r LIMIT 5),
flags AS (SELECT resource_id, """ + ", ".join(
    f"CAST(coalesce(list_contains(detected_codes, (SELECT code FROM top WHERE r = {i})), false) AS INTEGER) AS code_{i}"
    for i in range(1, 6)
) + " FROM coded)"


@query("code_correlation", with_(DOCS, HITS, CODE_COUNTS, TOP, select="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT 'code_{i}' AS a, 'code_{j}' AS b, round(corr(code_{i}, code_{j}), 14) AS corr FROM flags"
    for i in range(1, 6) for j in range(i + 1, 6)
) + ") WHERE corr IS NOT NULL AND NOT isnan(corr)"))
def _(t):
    codes = monitor.top_codes(t.coded)
    names = [f"code_{i}" for i in range(1, len(codes) + 1)]
    return monitor.correlations(monitor.code_flags(t.coded, codes).select(*names), names)


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_columns", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
 quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
FROM lineitem""" for c in LINE_COLUMNS))
def _(t):
    return monitor.describe_columns(t.raw("lineitem"), LINE_COLUMNS)


@query("describe_text", with_("""m AS (SELECT length(text)::DOUBLE AS pdf_text_length,
 len(regexp_extract_all(text, '\\S+'))::DOUBLE AS pdf_text_word_count FROM documents)""", select=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
 quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
FROM m""" for c in ("pdf_text_length", "pdf_text_word_count"))))
def _(t):
    return monitor.describe_columns(text_measures(t.doc_content), ["pdf_text_length", "pdf_text_word_count"])


@query("length_buckets", with_(DOCS, HITS, select=" UNION ALL ".join(f"""
SELECT '{name}' AS bucket, count(CASE WHEN {cond} THEN 1 END) AS n,
 round(count(CASE WHEN {cond} THEN 1 END)::DOUBLE / count(*), 14) AS share FROM coded""" for name, cond in (
    ("under 1000", "length(pdf_text) < 1000"), ("1000 to 4999", "length(pdf_text) >= 1000 AND length(pdf_text) < 5000"),
    ("5000 and more", "length(pdf_text) >= 5000"), ("no codes", "codes_count = 0"),
    ("1 to 3 codes", "codes_count BETWEEN 1 AND 3"), ("more than 3 codes", "codes_count > 3"),
    ("under 50", "length(pdf_text) < 50"), ("under 10", "length(pdf_text) < 10"), ("100 and more", "length(pdf_text) >= 100"),
))))
def _(t):
    size, codes = F.length("pdf_text"), F.col("codes_count")
    return monitor.length_buckets(t.coded, "pdf_text", [
        ("under 1000", size < 1000), ("1000 to 4999", (size >= 1000) & (size < 5000)), ("5000 and more", size >= 5000),
        ("no codes", codes == 0), ("1 to 3 codes", codes.between(1, 3)), ("more than 3 codes", codes > 3),
        ("under 50", size < 50), ("under 10", size < 10), ("100 and more", size >= 100),
    ])


@query("quality_profile", with_(NOTICES, select=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, 0 AS infinities, count(CASE WHEN {c} = 0 THEN 1 END) AS zeros,
 round((count(*) - count({c}))::DOUBLE / count(*), 14) AS null_share,
 round(count(CASE WHEN {c} = 0 THEN 1 END)::DOUBLE / count(*), 14) AS zero_share,
 count(CASE WHEN {c} = 0 THEN 1 END)::DOUBLE / count(*) > 0.5 AS mostly_zero FROM notices""" for c in ("value", "bid", "resource_id"))))
def _(t):
    return monitor.quality_profile(t.notices, ["value", "bid", "resource_id"])


def _engineered(t):
    return presence_flags(text_features(t.measured.where(F.col("bid").isNotNull())))


ENGINEERED = r"""engineered AS (
 SELECT n.resource_id, n.bid, n.pdf_url, length(n.title) AS title_length, len(regexp_extract_all(n.title, '\S+')) AS title_word_count,
  length(coalesce(c.pdf_text, '')) AS pdf_text_length, len(regexp_extract_all(coalesce(c.pdf_text, ''), '\S+')) AS pdf_text_word_count,
  coalesce(c.codes_count, 0) AS codes_count,
  length(coalesce(c.pdf_text, ''))::DOUBLE / (length(n.title) + 1) AS pdf_to_title_ratio,
  coalesce(c.codes_count, 0)::DOUBLE / (length(coalesce(c.pdf_text, '')) / 1000.0 + 1) AS code_density,
  CASE WHEN n.pdf_url <> '' THEN 1 ELSE 0 END AS has_pdf,
  CASE WHEN length(trim(coalesce(c.pdf_text, ''))) > 0 THEN 1 ELSE 0 END AS has_pdf_content,
  CASE WHEN coalesce(c.codes_count, 0) > 0 THEN 1 ELSE 0 END AS has_codes
 FROM notices n LEFT JOIN coded c USING (resource_id) WHERE n.bid IS NOT NULL)"""
FEATURES = ["title_length", "title_word_count", "pdf_text_length", "pdf_text_word_count", "codes_count",
            "pdf_to_title_ratio", "code_density", "has_pdf", "has_codes"]


@query("high_correlations", with_(NOTICES, DOCS, HITS, ENGINEERED, select="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 14) AS corr FROM engineered"
    for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]
) + ") WHERE corr IS NOT NULL AND NOT isnan(corr) AND abs(corr) > 0.8"))
def _(t):
    return monitor.high_correlations(_engineered(t), FEATURES)


@query("feature_label_corr", with_(NOTICES, DOCS, HITS, ENGINEERED, select="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, round(corr({a}, bid), 14) AS corr FROM engineered" for a in FEATURES
) + ") WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY abs(corr) DESC, feature LIMIT 10"))
def _(t):
    return monitor.feature_label_corr(_engineered(t), FEATURES)


@query("correlations_with_gaps", """
SELECT * FROM (SELECT 'value' AS a, 'user_id' AS b, round(corr(v, user_id), 14) AS corr FROM e
 UNION ALL SELECT 'value', 'k', round(corr(v, k), 14) FROM e UNION ALL SELECT 'user_id', 'k', round(corr(user_id, k), 14) FROM e)
""".replace(" FROM e", " FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS v, user_id, CAST(props->>'k' AS DOUBLE) AS k FROM events)"))
def _(t):
    events = t.raw("events").select(
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "user_id",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    return monitor.correlations(events, ["value", "user_id", "k"])


@query("crosstab_margins", with_(NOTICES, DOCS, HITS, ENGINEERED, select="""
SELECT CASE WHEN grouping(has_codes) = 1 THEN 'All' ELSE CAST(has_codes AS VARCHAR) END AS has_codes,
 CASE WHEN grouping(bid) = 1 THEN 'All' ELSE CAST(bid AS VARCHAR) END AS bid, count(*) AS n
FROM engineered GROUP BY CUBE (has_codes, bid)"""))
def _(t):
    return monitor.crosstab_margins(_engineered(t), "has_codes", "bid")


@query("bid_rate_by_flag", with_(NOTICES, DOCS, HITS, ENGINEERED, select="""
SELECT round(avg(CASE WHEN has_pdf = 1 THEN bid END), 14) AS rate_with, round(avg(CASE WHEN has_pdf = 0 THEN bid END), 14) AS rate_without,
 round(avg(CASE WHEN has_pdf = 1 THEN bid END) - avg(CASE WHEN has_pdf = 0 THEN bid END), 14) AS difference FROM engineered"""))
def _(t):
    return monitor.bid_rate_by_flag(_engineered(t), "has_pdf")


@query("bid_rate_by_codes", with_(NOTICES, DOCS, HITS, ENGINEERED, select="""
SELECT codes_count, count(bid) AS n, round(avg(bid), 3) AS rate FROM engineered GROUP BY 1"""))
def _(t):
    return monitor.bid_rate_by(_engineered(t), "codes_count")


@query("class_balance", with_(NOTICES, select="""
SELECT negatives, positives, round(p, 14) AS positive_share, round(q, 14) AS negative_share,
 round(greatest(positives, negatives)::DOUBLE / nullif(least(positives, negatives), 0), 14) AS imbalance_ratio,
 CASE WHEN least(p, q) < 0.1 THEN 'severe' WHEN least(p, q) < 0.2 THEN 'moderate' ELSE 'balanced' END AS severity
FROM (SELECT count(CASE WHEN bid = 0 THEN 1 END) AS negatives, count(CASE WHEN bid = 1 THEN 1 END) AS positives,
 count(CASE WHEN bid = 1 THEN 1 END)::DOUBLE / count(bid) AS p, count(CASE WHEN bid = 0 THEN 1 END)::DOUBLE / count(bid) AS q FROM notices)"""))
def _(t):
    return monitor.class_balance(t.notices)


@query("text_profile", with_(DOCS, select="""
SELECT min(length(pdf_text)) AS min_length, max(length(pdf_text)) AS max_length,
 quantile_cont(length(pdf_text), 0.5) AS median_length, round(avg(length(pdf_text)), 14) AS mean_length,
 count(CASE WHEN contains(lower(pdf_text), 'of the') THEN 1 END) AS with_phrase FROM doc_content"""))
def _(t):
    return monitor.text_profile(t.doc_content, "pdf_text", "Of the")


@query("dataset_funnel", with_(NOTICES, DOCS, select="""
SELECT *, round(with_text::DOUBLE / nullif(labelled, 0), 14) AS text_share, round(modelling::DOUBLE / nullif(labelled, 0), 14) AS modelling_share
FROM (SELECT count(*) AS all_rows, count(bid) AS labelled,
 count(CASE WHEN bid IS NOT NULL AND length(trim(pdf_text)) > 0 THEN 1 END) AS with_text,
 count(CASE WHEN bid IS NOT NULL AND length(trim(pdf_text)) > 0 AND length(pdf_text) >= 10 THEN 1 END) AS modelling
FROM notices n LEFT JOIN doc_content d USING (resource_id))"""))
def _(t):
    return monitor.dataset_funnel(t.notices.join(text.text_sizes(t.doc_content), "resource_id", "left"))


@query("ingest_counters", with_(NOTICES, DOCS, select="""
SELECT count(*) AS processed, count(d.resource_id) AS filtered, count(*) - count(d.resource_id) AS saved,
 count(CASE WHEN d.resource_id IS NULL AND pdf_url <> '' THEN 1 END) AS queued
FROM notices n LEFT JOIN doc_content d USING (resource_id)"""))
def _(t):
    marked = joins.mark_processed(t.notices.select("resource_id", "pdf_url"), t.doc_content)
    return monitor.ingest_counters(marked, {
        "processed": F.lit(True), "filtered": F.col("has_doc"), "saved": ~F.col("has_doc"),
        "queued": ~F.col("has_doc") & joins.has_url(),
    })


@query("value_counts", with_(DOCS, HITS, select="SELECT codes_count, count(*) AS n FROM coded GROUP BY 1"))
def _(t):
    return monitor.value_counts(t.coded, "codes_count")


@query("topk_terms", with_("""words AS (
 SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pM\\p{Nd}\\p{Pc}]+')) AS term FROM documents),
counts AS (SELECT lang, term, count(*) AS n FROM words WHERE term <> '' GROUP BY 1, 2)""", select="""
SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM counts
QUALIFY rank <= 10"""))
def _(t):
    words = t.raw("documents").select("lang", F.explode(word_tokens(F.lower("text"))).alias("term")).where("term <> ''")
    return monitor.top_k_per_group(words.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n")), "lang", "term", "n", 10)


@query("top_codes", with_(DOCS, HITS, CODE_COUNTS, select="SELECT code, n FROM code_counts ORDER BY n DESC, code LIMIT 5"))
def _(t):
    return monitor.top_k(monitor.code_statistics(t.coded).select("code", "n"), "code", "n", 5)
