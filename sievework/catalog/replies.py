"""Replies, notifications and digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.adapters import AS_OF, URL_BASE
from sievework.catalog.base import NOTICES, query, with_
from sievework.functions import reply

# Replies of several kinds, made of the assistant turns. Kinds by place: clean JSON, fenced JSON,
# JSON inside prose, JSON with missing and ill-typed fields, plain prose.
WORDS = ["BID", "NO BID", "do not bid, outside scope", "review the catering contract"]


def _replies(t):
    said = t.raw("conversations").where("role = 'assistant'")
    kind = (F.col("conv_id") + F.col("turn")) % 5
    word = F.element_at(F.array(*[F.lit(w) for w in WORDS]), ((F.col("conv_id") + F.floor(F.col("turn") / 2)) % 4 + 1).cast("int"))
    summary = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("Plumbing and CCTV override. "), F.col("text"))).otherwise(F.col("text"))
    full = F.to_json(F.struct(
        summary.alias("summary"), F.array(F.lit("first"), F.col("role")).alias("key_points"), word.alias("recommendation"),
        F.lit("High {certain}").alias("confidence_assessment"),
    ))
    # A brace inside a string is balanced in these texts, as the brace count needs.
    thin = F.lit('{"key_points": ["only", 7, null], "recommendation": 5}')
    plain_word = F.when(word == "BID", "You should bid").when(word == "NO BID", "I say no bid").otherwise(F.lit("A technical opportunity"))
    text = (
        F.when(kind == 0, F.concat(F.lit("\n "), full, F.lit(" \n")))
        .when(kind == 1, F.concat(F.lit("Here it is:\n```json\n"), full, F.lit("\n```\nDone.")))
        .when(kind == 2, F.concat(F.lit("The answer is "), full, F.lit(" as asked } {")))
        .when(kind == 3, thin)
        .when(F.col("conv_id") % 2 == 0, F.concat(plain_word, F.lit(". "), F.col("text")))
        .otherwise(F.concat(F.lit("{ broken "), F.col("text")))
    )
    return said.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("reply_id"), kind.alias("kind"), text.alias("reply"),
        full.alias("full"), thin.alias("thin"), (F.col("conv_id") % 2 == 0).alias("should_bid"),
        (F.col("turn") / F.lit(10.0)).alias("confidence"),
        F.when(F.col("turn") % 4 == 1, "TITLE_ONLY").otherwise("FULL_PDF").alias("summary_type"), "conv_id",
    )


# The same pieces in SQL. The parts of the JSON are known, so nothing has to be parsed.
MADE = """said AS (SELECT conv_id, turn, text, role, (conv_id + turn) % 5 AS kind, conv_id * 1000 + turn AS reply_id,
 CASE (conv_id + turn // 2) % 4 WHEN 0 THEN 'BID' WHEN 1 THEN 'NO BID' WHEN 2 THEN 'do not bid, outside scope' ELSE 'review the catering contract' END AS word,
 CASE WHEN conv_id % 3 = 0 THEN concat('Plumbing and CCTV override. ', text) ELSE text END AS said_summary,
 conv_id % 2 = 0 AS should_bid, turn / 10.0 AS confidence, CASE WHEN turn % 4 = 1 THEN 'TITLE_ONLY' ELSE 'FULL_PDF' END AS summary_type
 FROM conversations WHERE role = 'assistant'),
plain AS (SELECT *, concat(CASE word WHEN 'BID' THEN 'You should bid' WHEN 'NO BID' THEN 'I say no bid' ELSE 'A technical opportunity' END, '. ', text) AS prose,
 concat('{ broken ', text) AS broken FROM said),
texts AS (SELECT *, CASE WHEN kind < 3 THEN said_summary WHEN kind = 3 THEN '{"key_points": ["only", 7, null], "recommendation": 5}'
  WHEN conv_id % 2 = 0 THEN prose ELSE broken END AS ai_summary,
 CASE WHEN kind < 3 THEN 'first|assistant' WHEN kind = 3 THEN 'only' ELSE 'Claude response was in plain text format' END AS key_points,
 CASE WHEN kind < 3 THEN word WHEN kind = 3 THEN 'See summary' ELSE
  CASE WHEN conv_id % 2 = 1 THEN 'Review the summary for recommendations' WHEN word = 'BID' THEN 'BID' WHEN word = 'NO BID' THEN 'NO BID'
   ELSE 'BID - IT opportunity identified' END END AS recommendation,
 CASE WHEN kind < 3 THEN 'High {certain}' WHEN kind = 3 THEN 'Moderate confidence' ELSE 'Unknown - response format issue' END AS confidence_assessment
 FROM plain),
noted AS (SELECT *, concat(lower(ai_summary), ' ', lower(recommendation)) AS both_texts,
 CASE WHEN kind = 4 THEN ['Claude response could not be parsed as JSON'] ELSE
 list_concat(list_concat(list_concat(['Successfully parsed structured Claude response'],
  CASE WHEN kind < 3 AND (contains(lower(said_summary), 'overrid') OR contains(lower(said_summary), 'override')) THEN ['⚠️ Claude OVERRODE the ML prediction'] ELSE [] END),
  list_transform(list_filter(LISTWORDS, lambda w: contains(concat(lower(ai_summary), ' ', lower(recommendation)), w)), lambda w: concat('🚨 NON-IT INDICATOR DETECTED: ', w))),
  CASE WHEN len(list_filter(LISTPATTERNS, lambda w: contains(concat(lower(ai_summary), ' ', lower(recommendation)), w))) > 0
   THEN ['🚫 Claude RECOMMENDS NO BID - Non-IT opportunity'] ELSE [] END) END AS notes FROM texts)"""


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


MADE = MADE.replace("LISTWORDS", _sql_list(fv.NON_IT_INDICATORS)).replace("LISTPATTERNS", _sql_list(fv.NO_BID_PATTERNS))


@query("extract_json", with_(MADE, select="""
SELECT reply_id, kind, CASE WHEN kind = 4 THEN md5(ai_summary) WHEN kind = 3 THEN md5(ai_summary) ELSE 'block' END AS found FROM noted"""))
def _(t):
    found = reply.extract_json("reply")
    return _replies(t).select(
        "reply_id", "kind", F.when(F.col("kind") >= 3, F.md5(found)).when(found == F.col("full"), "block").otherwise(found).alias("found")
    )


@query("normalize_reply", with_(MADE, select="""
SELECT reply_id, ai_summary, key_points, recommendation, confidence_assessment, array_to_string(notes, '|') AS processing_notes FROM noted"""))
def _(t):
    return reply.normalize_reply(_replies(t)).select(
        "reply_id", "ai_summary", "key_points", "recommendation", "confidence_assessment", "processing_notes"
    )


@query("recommend_from_text", """
SELECT doc_id, CASE WHEN contains(t, 'recommend bid') OR contains(t, 'should bid') THEN 'BID'
 WHEN contains(t, 'no bid') OR contains(t, 'don''t bid') OR contains(t, 'do not bid') THEN 'NO BID'
 WHEN contains(t, 'this is an it') THEN 'BID - IT opportunity identified' ELSE 'Review the summary for recommendations' END AS recommendation
FROM (SELECT doc_id, lower(CASE doc_id % 5 WHEN 0 THEN concat(text, ' We SHOULD bid, no bid.') WHEN 1 THEN concat('Do not bid. ', text)
 WHEN 2 THEN concat('This is an IT job ', text) WHEN 3 THEN concat(text, ' don''t bid') ELSE text END) AS t FROM documents)""")
def _(t):
    key, text = F.col("doc_id") % 5, F.col("text")
    made = (
        F.when(key == 0, F.concat(text, F.lit(" We SHOULD bid, no bid."))).when(key == 1, F.concat(F.lit("Do not bid. "), text))
        .when(key == 2, F.concat(F.lit("This is an IT job "), text)).when(key == 3, F.concat(text, F.lit(" don't bid"))).otherwise(text)
    )
    return t.raw("documents").select("doc_id", reply.recommend_from_text(made).alias("recommendation"))


@query("processing_notes", with_(MADE, select="SELECT reply_id, array_to_string(notes, '|') AS notes FROM noted WHERE kind <> 4"))
def _(t):
    rows = reply.normalize_reply(_replies(t)).where("kind <> 4")
    notes = reply.processing_notes(F.col("reply"), F.col("ai_summary"), F.col("recommendation"))
    return rows.select("reply_id", notes.alias("notes"))


NOTIFY = """choices AS (SELECT *, CASE WHEN recommendation = 'Review the summary for recommendations' AND kind = 4 THEN should_bid
  ELSE contains(lower(recommendation), 'bid') AND NOT contains(lower(recommendation), 'no bid') END AS notify,
 len(list_filter(notes, lambda n: contains(n, 'OVERRODE'))) > 0 AS override, len(list_filter(notes, lambda n: contains(n, 'NON-IT INDICATOR'))) > 0 AS concern FROM noted),
notices_out AS (SELECT *, CASE WHEN override AND should_bid THEN 'CRITICAL' WHEN should_bid AND NOT concern THEN 'URGENT' WHEN concern THEN 'MEDIUM'
 WHEN summary_type = 'FULL_PDF' THEN 'HIGH' ELSE 'NORMAL' END AS priority,
 CASE WHEN override AND should_bid THEN '🚨 CRITICAL: Claude AI OVERRODE ML bid recommendation - review immediately for accuracy'
  WHEN should_bid THEN 'REVIEW IMMEDIATELY: ML recommends bidding - Claude analysis confirms opportunity'
  WHEN concern THEN '⚠️ Review recommended: Some non-IT indicators detected but passed initial screening'
  ELSE 'Review completed AI summary for strategic assessment' END AS action FROM choices)"""


@query("should_notify", with_(MADE, NOTIFY, select="""
SELECT reply_id, notify, CASE WHEN notify THEN '📧 EMAIL NOTIFICATION SENT - Analysis supports bid opportunity'
 ELSE '🚫 EMAIL NOTIFICATION SUPPRESSED - Analysis indicates no bid opportunity' END AS note,
 CASE WHEN recommendation = 'Review the summary for recommendations' AND kind = 4 THEN should_bid
  ELSE contains(lower(recommendation), 'bid') AND NOT contains(lower(recommendation), 'no bid')
   AND NOT contains(lower(recommendation), 'do not bid') END AS strict_notify FROM notices_out"""))
def _(t):
    noted = reply.with_notify_note(reply.normalize_reply(_replies(t)))
    return noted.select(
        "reply_id", "notify", F.element_at("processing_notes", -1).alias("note"), reply.should_notify(strict=True).alias("strict_notify")
    )


@query("notify_priority", with_(MADE, NOTIFY, select="SELECT reply_id, priority, action FROM notices_out"))
def _(t):
    rows = reply.normalize_reply(_replies(t))
    return rows.select("reply_id", reply.notify_priority().alias("priority"), reply.notify_action().alias("action"))


def _payloads(t):
    """Notifications of the notices that conversations happen to name."""
    replies = reply.normalize_reply(_replies(t)).withColumn("resource_id", F.col("conv_id"))
    joined = replies.join(t.notices.withColumns({
        "ml_status": F.lit("bid"), "ml_processed": F.lit(True),
    }), "resource_id").withColumn("reasoning", F.concat(F.lit("rule \""), F.col("title"), F.lit("\"")))
    return reply.notify_payload(joined, F.lit(AS_OF).cast("timestamp_ntz"), URL_BASE)


OUT = """out_rows AS (SELECT o.*, n.resource_id, n.title, n.ca, n.value, n.deadline, n.pdf_url, n.status, n.procedure
 FROM notices_out o JOIN notices n ON n.resource_id = o.conv_id)"""


@query("notify_payload", with_(NOTICES, MADE, NOTIFY, OUT, select="""
SELECT CAST(resource_id AS VARCHAR) AS resource_id, reply_id, title, priority, ai_summary AS summary, ca AS authority, CAST(value AS VARCHAR) AS estimated_value,
 override AS is_override, 'rule "' || title || '"' AS reasoning, len(notes) AS n_notes FROM out_rows"""))
def _(t):
    body = F.col("payload")
    read = lambda path: F.get_json_object(body, path)
    return _payloads(t).select(
        read("$.resource_id").alias("resource_id"), "reply_id", read("$.title").alias("title"), read("$.priority").alias("priority"),
        read("$.summary").alias("summary"), read("$.metadata.contracting_authority").alias("authority"),
        read("$.metadata.estimated_value").alias("estimated_value"),
        read("$.metadata.claude_override").cast("boolean").alias("is_override"),
        read("$.metadata.ml_prediction.reasoning").alias("reasoning"),
        F.json_array_length(read("$.metadata.processing_notes")).alias("n_notes"),
    )


DIGEST = """digest AS (SELECT 'Tender Opportunity' AS subject, CAST(resource_id AS VARCHAR) AS resource_id, title, ca AS contracting_authority,
 ai_summary AS summary, priority, round(confidence * 100) AS prediction_confidence, strftime(deadline, '%Y-%m-%dT%H:%M:%S') AS deadline,
 CAST(value AS VARCHAR) AS estimated_value, '2001-08-01 00:00:00 UTC' AS timestamp, concat('https://example.org/notice?id=', resource_id) AS portal_link,
 ai_summary, key_points, recommendation, confidence_assessment, pdf_url, 'rule "' || title || '"' AS ml_reasoning FROM out_rows)"""


def _digests(t):
    """Payloads with the metadata as an object, and as a string for every other conversation."""
    whole = F.col("payload")
    as_string = F.to_json(F.struct(
        *[F.get_json_object(whole, f"$.{n}").alias(n) for n in ("message_type", "resource_id", "title", "priority", "summary", "action_required", "timestamp", "metadata")]
    ))
    mixed = _payloads(t).withColumn("payload", F.when(F.col("conv_id") % 2 == 0, as_string).otherwise(whole))
    return reply.digest_rows(mixed, URL_BASE)


@query("digest_rows", with_(NOTICES, MADE, NOTIFY, OUT, DIGEST, select="SELECT * FROM digest"))
def _(t):
    return _digests(t)


SECTION = "concat('{0}', chr(10), repeat('-', {1}), chr(10), {2}, chr(10))"


def _section(title: str, body: str, keep: str | None = None) -> str:
    sql = SECTION.format(title, len(title), body)
    return sql if keep is None else f"CASE WHEN {keep} THEN {sql} END"


@query("digest_text", with_(NOTICES, MADE, NOTIFY, OUT, DIGEST, select=f"""
SELECT md5(concat_ws(chr(10), concat('NOTICE NOTIFICATION', chr(10), repeat('=', 19), chr(10)), concat(subject, chr(10)),
 {_section('DETAILS', '''concat_ws(chr(10), concat('ID: ', resource_id), concat('Title: ', title), concat('Contracting Authority: ', contracting_authority),
  concat('Priority: ', priority), concat('Deadline: ', deadline), CASE WHEN estimated_value <> '' THEN concat('Estimated Value: ', estimated_value) END,
  CASE WHEN prediction_confidence <> 0 THEN concat('Match Confidence: ', CAST(CAST(prediction_confidence AS INTEGER) AS VARCHAR), '.0%') END,
  concat('Notification Time: ', timestamp))''')},
 {_section('AI SUMMARY', 'ai_summary', "ai_summary <> ''")},
 {_section('KEY POINTS', "concat('• ', replace(key_points, '|', concat(chr(10), '• ')))", "ai_summary <> ''")},
 {_section('RECOMMENDATION', 'recommendation', "ai_summary <> ''")},
 {_section('CONFIDENCE ASSESSMENT', 'confidence_assessment', "ai_summary <> ''")},
 {_section('ML ANALYSIS', 'ml_reasoning', "ai_summary <> ''")},
 {_section('VIEW FULL NOTICE', 'portal_link')},
 {_section('VIEW PDF DOCUMENT', 'pdf_url', "pdf_url <> ''")},
 {_section('NOTIFICATION DETAILS', "concat('This is an automated notification.', chr(10), 'Generated on ', timestamp)")})) AS digest_md5, resource_id FROM digest"""))
def _(t):
    return _digests(t).select(F.md5(reply.digest_text()).alias("digest_md5"), "resource_id")


@query("priority_class", with_(MADE, NOTIFY, select="""
SELECT reply_id, CASE WHEN priority = 'URGENT' THEN 'Urgent' WHEN priority = 'HIGH' THEN 'High' ELSE 'Normal' END AS priority FROM notices_out"""))
def _(t):
    rows = reply.normalize_reply(_replies(t))
    return rows.select("reply_id", reply.priority_class(F.lower(reply.notify_priority())).alias("priority"))


def _recipients():
    """Three addresses made of a customer's name, of which one or two hold."""
    name = F.replace("c_name", F.lit("#"), F.lit("."))
    return F.concat(
        name, F.lit("@example.org , "), F.when(F.col("c_custkey") % 2 == 0, F.lit("@x.org,")).otherwise("b@c@d.e,"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("a@nodot")).otherwise("a@b."), F.lit(", ,"),
    )


@query("valid_recipients", """
SELECT c_custkey, concat(replace(c_name, '#', '.'), '@example.org', CASE WHEN c_custkey % 3 <> 0 THEN '|a@b.' ELSE '' END) AS recipients FROM customer""")
def _(t):
    return t.raw("customer").select("c_custkey", reply.valid_recipients(_recipients()).alias("recipients"))


@query("notification_fanout", with_(MADE, NOTIFY, select="""
SELECT reply_id, priority, r.recipient FROM notices_out, (VALUES ('a@example.org'), ('b@example.org')) r(recipient) WHERE notify"""))
def _(t):
    noted = reply.with_notify_note(reply.normalize_reply(_replies(t))).where("notify")
    sent = noted.select("reply_id", reply.notify_priority().alias("priority"))
    return reply.notification_fanout(sent, F.lit("a@example.org, nobody, b@example.org ,"))
