"""Scans, ingest, upserts and write-backs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework import schemas
from sievework.adapters import URL_BASE
from sievework.catalog.base import DOCS, HITS, NOTICES, RAW_NOTICES, query, with_
from sievework.operators import monitor, search, upsert
from sievework.plans import screening
from sievework.sources import listing, messages, store

FMT = "'%Y-%m-%d %H:%M:%S'"
COLUMNS = f"""resource_id, title, ca, info, procedure, status, pdf_url, cycle, strftime(published, {FMT}) AS published,
 strftime(deadline, {FMT}) AS deadline, CAST(value AS DOUBLE) AS value, CAST(bid AS BIGINT) AS bid"""
KEPT = ("resource_id", "title", "ca", "info", "procedure", "status", "pdf_url", "cycle", "published", "deadline", "value", "bid")
NOW = "2001-08-02 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("scan_notices", with_(NOTICES, select=f"SELECT {COLUMNS} FROM notices WHERE bid IS NOT NULL"))
def _(t):
    return store.labelled(t.notices).select(*KEPT)


@query("scan_notices_with_text", with_(NOTICES, DOCS, HITS, select="""
SELECT n.resource_id, n.title, n.bid, coalesce(c.pdf_text, '') AS pdf_text,
 array_to_string(coalesce(c.detected_codes, CAST([] AS VARCHAR[])), '|') AS detected_codes, coalesce(c.codes_count, 0) AS codes_count
FROM notices n LEFT JOIN coded c USING (resource_id) WHERE n.bid IS NOT NULL"""))
def _(t):
    joined = search.scan_notices_with_text(t.notices, t.coded, include_unlabelled=False)
    return joined.select("resource_id", "title", "bid", "pdf_text", "detected_codes", "codes_count")


@query("scan_notices_text_only", with_(NOTICES, DOCS, HITS, select="""
SELECT n.resource_id, n.title, c.pdf_text, c.codes_count FROM notices n JOIN coded c USING (resource_id)
WHERE length(trim(c.pdf_text, E' \\t\\n\\r')) > 0"""))
def _(t):
    joined = search.scan_notices_with_text(t.notices, t.coded, with_text_only=True)
    return joined.select("resource_id", "title", "pdf_text", "codes_count")


# -- pages ----------------------------------------------------------------------------------------

def _pages(t, layout="v1"):
    """Listing pages of ten rows each, made from the raw notices."""
    key = F.col("resource_id").cast("bigint")
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    title = F.concat(F.lit("<td><a href='#'>"), F.col("title"), F.lit("</a> </td>"))
    blank = F.lit("")
    document = F.when(F.col("pdf_url") != "", "<img src='pdf.png'>").otherwise("")
    dates = [F.col("published"), F.col("deadline"), F.col("procedure"), F.col("status")]
    middle = [*dates, document, blank] if layout == "v1" else [blank, *dates, document]
    cells = [cell(blank), title, cell(F.col("resource_id")), cell(F.col("ca"))]
    cells += [cell(c) for c in [*middle, F.col("awarddate"), F.col("value")]]
    row = F.concat(F.lit("<tr class='row'>"), *cells, F.lit("</tr>\n"))
    rows = t.raw_notices.select(listing.page_number(key).alias("page_no"), key.alias("k"), row.alias("row"))
    # Ten rows make a page, so the lists stay small.
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "row"))), lambda r: r["row"]), "")
    head = F.lit("<html><table><thead><tr><th>No</th></tr></thead><tbody>\n")
    return rows.groupBy("page_no").agg(F.concat(head, body, F.lit("</tbody></table></html>")).alias("html"))


LISTED = """SELECT CAST(floor(CAST(resource_id AS BIGINT) / 10) AS BIGINT) + 1 AS page_no, CAST(resource_id AS BIGINT) % 10 AS row_no,
 title, resource_id, ca, '' AS info, published, deadline, procedure, status, {url} AS pdf_url, awarddate, value, '' AS cycle FROM raw_notices"""


@query("extract_listing_rows", with_(NOTICES, RAW_NOTICES, select=LISTED.format(url="concat('https://example.org/notice?id=', resource_id)")))
def _(t):
    return listing.extract_listing_rows(_pages(t), URL_BASE)


@query("extract_listing_rows_v2", with_(NOTICES, RAW_NOTICES, select=LISTED.format(url="pdf_url")))
def _(t):
    good, _bad = listing.split_bad_keys(listing.extract_listing_rows(_pages(t, "v2"), URL_BASE, "v2"))
    return good


def _numbered(t):
    """The raw pages with the page number of a site of 53 pages."""
    return t.raw("pages").select(((F.col("page_id") % 53) + 1).alias("page_no"), "page_id", "url")


NUMBERED = "numbered AS (SELECT page_id % 53 + 1 AS page_no, page_id, url FROM pages)"


@query("page_window", with_(NUMBERED, select="SELECT * FROM numbered WHERE page_no >= 5 AND page_no < 15"))
def _(t):
    return listing.select_pages(_numbered(t), start_page=5, max_pages=10)


@query("page_window_offset", with_(NUMBERED, select="SELECT * FROM numbered WHERE page_no BETWEEN 1 AND 7"))
def _(t):
    return listing.select_pages(_numbered(t), start_page=5, offset=7)


@query("backfill_chunks", with_(NUMBERED, select="""
SELECT (page_no - 1) // 5 AS chunk_id, min(page_no) AS start_page, count(DISTINCT page_no) AS max_pages, count(*) AS n_rows
FROM numbered GROUP BY 1"""))
def _(t):
    return listing.backfill_chunks(_numbered(t), 5)


@query("union_pages", with_(NOTICES, RAW_NOTICES, select=f"""
{LISTED.format(url="concat('https://example.org/notice?id=', resource_id)")} UNION ALL {LISTED.format(url="pdf_url")}"""))
def _(t):
    return listing.union_pages(
        listing.extract_listing_rows(_pages(t), URL_BASE), listing.extract_listing_rows(_pages(t, "v2"), URL_BASE, "v2")
    )


# -- messages -------------------------------------------------------------------------------------

RECORD = schemas.T.StructType([f for f in schemas.NOTICES.fields if f.name in ("resource_id", "title", "ca", "status", "bid")])


def _bodies(t):
    """Notices as message bodies; every 50th is cut in half."""
    body = F.to_json(F.struct("resource_id", "title", "ca", "status", "bid"))
    cut = F.when(F.col("resource_id") % 50 == 0, F.expr("substring(body, 1, length(body) div 2)")).otherwise(F.col("body"))
    return t.notices.select("resource_id", body.alias("body")).select(F.col("resource_id").alias("k"), cut.alias("body"))


@query("ingest_messages", with_(NOTICES, select="""
SELECT resource_id, title, ca, status, CAST(bid AS BIGINT) AS bid FROM notices WHERE resource_id % 50 <> 0"""))
def _(t):
    return messages.good_records(messages.parse_messages(_bodies(t), RECORD))


@query("quarantine", with_(NOTICES, select="""
SELECT 'not parseable' AS reason, 1 AS attempt, count(*) AS n FROM notices WHERE resource_id % 50 = 0"""))
def _(t):
    held = messages.quarantined(messages.parse_messages(_bodies(t), RECORD))
    return held.groupBy("reason", "attempt").agg(F.count(F.lit(1)).alias("n"))


@query("retry_quarantine", with_(NOTICES, select="""
SELECT 'dead letter' AS fate, count(*) AS n FROM notices WHERE resource_id % 50 = 0"""))
def _(t):
    """Three tries of the same bad bodies end as dead letters."""
    held = messages.quarantined(messages.parse_messages(_bodies(t), RECORD))
    for _try in range(2):
        again, _dead = messages.retry_candidates(held, max_attempts=3)
        held = messages.quarantined(messages.parse_messages(again, RECORD))
    again, dead = messages.retry_candidates(held, max_attempts=3)
    fates = again.select(F.lit("retry").alias("fate")).unionByName(dead.select(F.lit("dead letter").alias("fate")))
    return fates.groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


def _union_bodies(t):
    """Scored messages for odd keys, bare records for even ones."""
    key = F.col("resource_id")
    scored = F.to_json(F.struct(
        key.cast("string").alias("resource_id"), F.col("title").alias("tender_title"),
        F.struct(
            (key % 3 == 0).alias("should_bid"), (F.col("value").cast("double") / 1e6).alias("confidence"),
            F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise("by rule").alias("reasoning"),
            F.struct(F.lit(0.25).alias("codes_count_score")).alias("feature_scores"),
        ).alias("ml_prediction"),
        F.when(key % 5 == 0, F.lit(None).cast("string")).otherwise("text").alias("pdf_content"),
        F.when(key % 3 == 0, "URGENT").otherwise("NORMAL").alias("priority"),
        F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
    ))
    bare = F.to_json(F.struct(key, "title", "ca", F.lit("body text").alias("pdf_content")))
    return t.notices.select(F.when(key % 2 == 1, scored).otherwise(bare).alias("body"))


@query("normalize_union_messages", with_(NOTICES, select=f"""
SELECT resource_id, title, CASE WHEN resource_id % 2 = 1 THEN resource_id % 3 = 0 ELSE true END AS should_bid,
 CASE WHEN resource_id % 2 = 1 THEN round(CAST(value AS DOUBLE) / 1e6, 14) ELSE 0.5 END AS confidence,
 CASE WHEN resource_id % 2 = 0 THEN 'Direct processing - no ML prediction available'
  WHEN resource_id % 7 = 0 THEN 'No reasoning provided' ELSE 'by rule' END AS reasoning,
 CASE WHEN resource_id % 2 = 1 THEN 0.25::DOUBLE ELSE 0.0 END AS codes_count_score, 0.0::DOUBLE AS total_score,
 CASE WHEN resource_id % 2 = 0 THEN 'body text' WHEN resource_id % 5 = 0 THEN '' ELSE 'text' END AS pdf_content,
 CASE WHEN resource_id % 2 = 1 AND resource_id % 3 = 0 THEN 'URGENT' ELSE 'NORMAL' END AS priority,
 CASE WHEN resource_id % 2 = 1 THEN strftime(published, {FMT}) ELSE '{NOW}' END AS timestamp FROM notices"""))
def _(t):
    shaped = messages.normalize_union_messages(_union_bodies(t), now=_now()).where("reason IS NULL")
    p = F.col("ml_prediction")
    return shaped.select(
        "resource_id", "title", p["should_bid"].alias("should_bid"), p["confidence"].alias("confidence"),
        p["reasoning"].alias("reasoning"), p["feature_scores"]["codes_count_score"].alias("codes_count_score"),
        p["feature_scores"]["total_score"].alias("total_score"), "pdf_content", "priority", "timestamp",
    )


@query("json_defaults", with_(NOTICES, select="""
SELECT resource_id, CASE WHEN resource_id % 7 = 0 THEN 'No reasoning provided' ELSE 'by rule' END AS reasoning,
 0.25::DOUBLE AS codes_count_score, 0.0::DOUBLE AS has_codes_score, 0.0::DOUBLE AS title_length_score, 0.0::DOUBLE AS ca_score,
 0.0::DOUBLE AS text_features_score, 0.0::DOUBLE AS total_score FROM notices WHERE resource_id % 2 = 1"""))
def _(t):
    parsed = messages.parse_messages(_union_bodies(t), schemas.UNION_MESSAGE).select("record.*")
    filled = parsed.withColumn("p", messages.with_defaults()).where("p IS NOT NULL")
    return filled.select(F.col("resource_id").cast("bigint").alias("resource_id"), "p.reasoning", "p.feature_scores.*")


# -- upserts and write-backs ----------------------------------------------------------------------
# The store holds what was published before 2000; the batch is everything since 1999 with new titles.

def _stored(t):
    old = t.notices.where(F.col("published") < F.lit("2000-01-01").cast("timestamp_ntz"))
    marked = old.withColumns({"ml_status": F.lit("bid"), "ml_processed": F.lit(True), "created_at": F.col("published")})
    return store.migrate_notices(marked)


def _batch(t):
    """Two arrivals per notice; the later one has the title in capitals."""
    new = t.notices.where(F.col("published") >= F.lit("1999-01-01").cast("timestamp_ntz")).drop("created_at", "bid")
    twice = new.withColumn("arrival", F.explode(F.array(F.lit(1), F.lit(2))))
    return twice.withColumn("title", F.when(F.col("arrival") == 2, F.upper("title")).otherwise(F.col("title")))


MERGED = f"""merged AS (SELECT {COLUMNS.replace('title, ca', "CASE WHEN published >= TIMESTAMP '1999-01-01' THEN upper(title) ELSE title END AS title, ca").replace(
 'CAST(bid AS BIGINT) AS bid', "CASE WHEN published < TIMESTAMP '2000-01-01' THEN CAST(bid AS BIGINT) END AS bid")},
 CASE WHEN notices.published < TIMESTAMP '2000-01-01' THEN 'bid' ELSE 'pending' END AS ml_status,
 notices.published < TIMESTAMP '2000-01-01' AS ml_processed FROM notices)"""


@query("upsert_notices", with_(NOTICES, MERGED, select="SELECT * FROM merged"))
def _(t):
    merged = upsert.upsert_notices(_stored(t), _batch(t), order_by="arrival")
    return merged.select(*KEPT, "ml_status", "ml_processed")


@query("upsert_notices_twice", with_(NOTICES, MERGED, select="SELECT * FROM merged"))
def _(t):
    """A replayed batch changes nothing."""
    batch = _batch(t)
    once = upsert.upsert_notices(_stored(t), batch, order_by="arrival")
    return upsert.upsert_notices(once, batch, order_by="arrival").select(*KEPT, "ml_status", "ml_processed")


def _twice(rows, column):
    """Each row in two arrivals, the first with another text in ``column``."""
    both = rows.withColumn("arrival", F.explode(F.array(F.lit(1), F.lit(2))))
    return both.withColumn(column, F.when(F.col("arrival") == 1, F.lit("first")).otherwise(F.col(column)))


@query("upsert_doc_content", with_(DOCS, HITS, """
old AS (SELECT * FROM coded WHERE extraction_timestamp < TIMESTAMP '2001-07-31 12:00:00'),
new AS (SELECT * FROM coded WHERE extraction_timestamp >= TIMESTAMP '2001-07-31 00:00:00')""", select=f"""
SELECT resource_id, concat('new ', pdf_text) AS pdf_text, 'COMPLETED' AS processing_status, '{NOW}' AS extraction_timestamp,
 array_to_string(detected_codes, '|') AS detected_codes, codes_count FROM new
UNION ALL SELECT resource_id, pdf_text, processing_status, strftime(extraction_timestamp, {FMT}), array_to_string(detected_codes, '|'), codes_count
FROM old WHERE resource_id NOT IN (SELECT resource_id FROM new)"""))
def _(t):
    ts = F.col("extraction_timestamp")
    old = store.migrate_doc_content(t.coded.where(ts < F.lit("2001-07-31 12:00:00").cast("timestamp_ntz"))).drop("metadata")
    new = t.coded.where(ts >= F.lit("2001-07-31 00:00:00").cast("timestamp_ntz")).select(
        "resource_id", F.concat(F.lit("new "), F.col("pdf_text")).alias("pdf_text"), "detected_codes"
    )
    return upsert.upsert_doc_content(old, _twice(new, "pdf_text"), _now(), "arrival")


def _summaries(t):
    """Assistant turns as summaries, one per conversation turn."""
    said = t.raw("conversations").where("role = 'assistant'")
    return said.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("resource_id"), F.lit("FULL_PDF").alias("summary_type"),
        F.col("text").alias("ai_summary"), F.lit("BID").alias("recommendation"), "turn",
    )


@query("upsert_summaries", with_("""said AS (SELECT conv_id * 1000 + turn AS resource_id, text, turn FROM conversations WHERE role = 'assistant'),
old AS (SELECT * FROM said WHERE turn < 4), new AS (SELECT * FROM said WHERE turn >= 2)""", select=f"""
SELECT coalesce(o.resource_id, n.resource_id) AS resource_id, CASE WHEN n.resource_id IS NULL THEN o.text ELSE concat('new ', n.text) END AS ai_summary,
 CASE WHEN o.resource_id IS NULL THEN '2001-08-05 00:00:00' ELSE '2001-08-01 00:00:00' END AS created_at,
 CASE WHEN n.resource_id IS NULL THEN '2001-08-01 00:00:00' ELSE '{NOW}' END AS updated_at
FROM old o FULL JOIN new n ON o.resource_id = n.resource_id"""))
def _(t):
    said = _summaries(t)
    first = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    old = schemas.align_schema(
        said.where("turn < 4").drop("turn").withColumns({"created_at": first, "updated_at": first}), schemas.SUMMARIES
    )
    new = said.where("turn >= 2").drop("turn").withColumns({
        "ai_summary": F.concat(F.lit("new "), F.col("ai_summary")), "created_at": F.lit("2001-08-05 00:00:00").cast("timestamp_ntz"),
    })
    merged = upsert.upsert_summaries(old, _twice(new, "ai_summary"), _now(), "arrival")
    return merged.select("resource_id", "ai_summary", "created_at", "updated_at")


def _decisions(t):
    """A decision for every notice with a value, and some for keys nobody knows."""
    known = t.notices.where("value IS NOT NULL").select(
        "resource_id", (F.col("value") >= 100000).alias("ml_bid"),
        (F.col("value") / 1000000).cast("decimal(5,4)").alias("ml_confidence"),
        F.lit("by value").alias("ml_reasoning"), F.when(F.col("value") >= 100000, "bid").otherwise("no-bid").alias("ml_status"),
    )
    unknown = t.raw("customer").select(
        (-1 - F.col("c_custkey")).alias("resource_id"), F.lit(True).alias("ml_bid"),
        F.lit(0).cast("decimal(5,4)").alias("ml_confidence"), F.lit("").alias("ml_reasoning"), F.lit("bid").alias("ml_status"),
    )
    return known.unionByName(unknown)


@query("update_predictions", with_(NOTICES, select=f"""
SELECT resource_id, title, value >= 100000 AS ml_bid, CAST(CAST(value / 1000000 AS DECIMAL(5,4)) AS DOUBLE) AS ml_confidence,
 CASE WHEN value IS NOT NULL THEN 'by value' END AS ml_reasoning,
 CASE WHEN value >= 100000 THEN 'bid' WHEN value IS NOT NULL THEN 'no-bid' ELSE 'pending' END AS ml_status,
 value IS NOT NULL AS ml_processed, CASE WHEN value IS NOT NULL THEN '{NOW}' END AS updated_at FROM notices"""))
def _(t):
    updated = upsert.update_predictions(store.migrate_notices(t.notices), _decisions(t).withColumn("arrival", F.lit(1)), _now(), "arrival")
    return updated.select("resource_id", "title", "ml_bid", "ml_confidence", "ml_reasoning", "ml_status", "ml_processed", "updated_at")


@query("unmatched_updates", "SELECT -1 - c_custkey AS resource_id FROM customer")
def _(t):
    return upsert.unmatched_updates(t.notices, _decisions(t)).select("resource_id")


@query("update_status", with_(NOTICES, select="""
SELECT resource_id, title, pdf_url = '' AS ml_processed, CASE WHEN pdf_url = '' THEN 'routing_error' ELSE 'pending' END AS ml_status FROM notices"""))
def _(t):
    errors = t.notices.where("pdf_url = ''").select(
        "resource_id", F.lit(True).alias("ml_processed"), F.lit("routing_error").alias("ml_status")
    )
    return upsert.update_status(store.migrate_notices(t.notices), _twice(errors, "ml_status"), "arrival").select("resource_id", "title", "ml_processed", "ml_status")


@query("mark_notified", with_(NOTICES, select=f"""
SELECT resource_id, status = 'Open' AS notification_sent, CASE WHEN status = 'Open' THEN '{NOW}' END AS notification_sent_at FROM notices"""))
def _(t):
    sent = t.notices.where("status = 'Open'").select("resource_id")
    marked = upsert.mark_notified(store.migrate_notices(t.notices), sent.union(sent), _now())
    return marked.select("resource_id", "notification_sent", "notification_sent_at")


@query("apply_labels", with_(NOTICES, select="""
SELECT n.resource_id, CASE l.quality * 3 + l.toxic WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 4 THEN 1 ELSE n.bid END AS bid
FROM notices n LEFT JOIN labels l ON n.resource_id = l.doc_id"""))
def _(t):
    grade = F.col("quality") * 3 + F.col("toxic")
    answers = t.raw("labels").select(
        F.col("doc_id").alias("resource_id"),
        F.when(grade == 0, " No").when(grade == 1, "n").when(grade == 4, "YES ").otherwise("maybe").alias("answer"),
    )
    return upsert.apply_labels(t.notices, answers.withColumn("arrival", F.lit(1)), "arrival").select("resource_id", "bid")


@query("apply_labels_repeated", with_(NOTICES, """
answers AS (SELECT o_custkey AS resource_id, o_orderkey AS arrival, CASE WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'F' THEN 0 END AS answer FROM orders),
last AS (SELECT resource_id, arg_max(answer, arrival) AS answer FROM answers WHERE answer IS NOT NULL GROUP BY 1)""", select="""
SELECT n.resource_id, coalesce(l.answer, CAST(n.bid AS BIGINT)) AS bid FROM notices n LEFT JOIN last l USING (resource_id)"""))
def _(t):
    """Many answers for one notice; of the clear ones the last counts, and no notice is repeated."""
    status = F.col("o_orderstatus")
    answers = t.raw("orders").select(
        F.col("o_custkey").alias("resource_id"), F.col("o_orderkey").alias("arrival"),
        F.when(status == "O", "y").when(status == "F", "n").otherwise("?").alias("answer"),
    )
    return upsert.apply_labels(t.notices, answers, "arrival").select("resource_id", "bid")


@query("update_predictions_repeated", with_(NOTICES, """
last AS (SELECT o_custkey AS resource_id, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1)""", select="""
SELECT n.resource_id, l.price >= 100000 AS ml_bid, CASE WHEN l.resource_id IS NOT NULL THEN 'last price' END AS ml_reasoning,
 CASE WHEN l.resource_id IS NULL THEN 'pending' WHEN l.price >= 100000 THEN 'bid' ELSE 'no-bid' END AS ml_status FROM notices n LEFT JOIN last l USING (resource_id)"""))
def _(t):
    """Many decisions for one notice; the last counts, and no notice is repeated."""
    bid = F.col("o_totalprice") >= 100000
    decided = t.raw("orders").select(
        F.col("o_custkey").alias("resource_id"), F.col("o_orderkey").alias("arrival"), bid.alias("ml_bid"), F.lit(0.5).alias("ml_confidence"),
        F.lit("last price").alias("ml_reasoning"), F.when(bid, "bid").otherwise("no-bid").alias("ml_status"),
    )
    updated = upsert.update_predictions(store.migrate_notices(t.notices), decided, _now(), "arrival")
    return updated.select("resource_id", "ml_bid", "ml_reasoning", "ml_status")


@query("ingest_raw", with_(NOTICES, """
raw AS (SELECT CASE WHEN resource_id % 97 = 0 THEN 0 ELSE resource_id END AS resource_id, concat(title, ' ', a) AS title, resource_id * 10 + a AS arrival
 FROM notices, (VALUES (1), (2)) v(a))""", select="""
SELECT resource_id, arg_max(title, arrival) AS title FROM raw GROUP BY 1"""))
def _(t):
    """Keys as texts: ``7`` and ``007`` are one key, and all that is no number is key 0."""
    key = F.col("resource_id")
    raw = t.raw_notices.withColumn("a", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({
        "arrival": key.cast("bigint") * 10 + F.col("a"), "title": F.concat_ws(" ", "title", F.col("a").cast("string")),
    }).withColumn("resource_id", F.when(key.cast("bigint") % 97 == 0, F.concat(F.lit("x"), key)).when(F.col("a") == 2, F.concat(F.lit("00"), key)).otherwise(key))
    stored = store.migrate_notices(t.notices.where("resource_id < 0"))
    return screening.ingest(raw.drop("a"), stored, "arrival")[0].select("resource_id", "title")


# -- routes and schema ----------------------------------------------------------------------------

@query("route_by_url", with_(NOTICES, select="""
SELECT CASE WHEN pdf_url <> '' THEN 'documents' ELSE 'direct' END AS route, count(*) AS n FROM notices GROUP BY 1"""))
def _(t):
    return monitor.value_counts(store.route_by_url(t.notices), "route")


@query("align_schema", with_(NOTICES, select=f"""
SELECT resource_id, title, ca, info, strftime(published, {FMT}) AS published, strftime(deadline, {FMT}) AS deadline, procedure, status, pdf_url,
 CAST(NULL AS VARCHAR) AS awarddate, CAST(value AS DOUBLE) AS value, cycle, CAST(bid AS BIGINT) AS bid, false AS notification_sent,
 CAST(NULL AS VARCHAR) AS notification_sent_at, strftime(created_at, {FMT}) AS created_at, CAST(NULL AS VARCHAR) AS updated_at,
 false AS ml_processed, CAST(NULL AS BOOLEAN) AS ml_bid, CAST(NULL AS DOUBLE) AS ml_confidence, CAST(NULL AS VARCHAR) AS ml_reasoning,
 'pending' AS ml_status FROM notices"""))
def _(t):
    return store.migrate_notices(store.migrate_notices(t.notices))
