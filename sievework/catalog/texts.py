"""Cleaning, text features, lexicon and rule score."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.adapters import AS_OF, TEST_LEXICON, URL_BASE
from sievework.catalog.base import DOCS, HITS, NOTICES, RAW_NOTICES, query, with_
from sievework.functions import clean, reply, text
from sievework.operators import lexicon, monitor, scoring, search
from sievework.operators.containment import detect_codes
from sievework.sources import messages, store

FMT = "'%Y-%m-%d %H:%M:%S'"
TOKENS = r"'[^\pL\pM\p{Nd}\p{Pc}]+'"
TERMS = list(TEST_LEXICON.key_terms)
NAMES = scoring.feature_names(TEST_LEXICON)


# -- cleaning -------------------------------------------------------------------------------------

@query("strip_html", """
SELECT page_id, trim(replace(regexp_replace(html, '<[^>]*(>|$)', '', 'g'), '>', ''), E' \\t\\n\\r') AS stripped FROM pages""")
def _(t):
    return t.raw("pages").select("page_id", clean.strip_html("html").alias("stripped"))


@query("parse_datetime", with_(NOTICES, RAW_NOTICES, select=f"""
SELECT resource_id, strftime(try_strptime(published, '%d/%m/%Y %H:%M:%S'), {FMT}) AS published,
 strftime(try_strptime(deadline, '%d/%m/%Y %H:%M:%S'), {FMT}) AS deadline FROM raw_notices"""))
def _(t):
    return t.raw_notices.select(
        "resource_id", clean.parse_datetime("published").alias("published"), clean.parse_datetime("deadline").alias("deadline")
    )


@query("parse_date", with_(NOTICES, RAW_NOTICES, """
forms AS (SELECT CAST(resource_id AS BIGINT) AS k, published, awarddate, resource_id FROM raw_notices),
mixed AS (SELECT k, CASE WHEN k%4=0 THEN published WHEN k%4=1 THEN awarddate WHEN k%4=2 THEN replace(awarddate, '/', '-')
  ELSE concat_ws('-', substr(awarddate, 7, 4), substr(awarddate, 4, 2), substr(awarddate, 1, 2)) END AS d FROM forms)""", select="""
SELECT k AS resource_id, strftime(coalesce(try_strptime(d, '%d/%m/%Y %H:%M:%S'), try_strptime(d, '%d/%m/%Y'),
 try_strptime(d, '%d-%m-%Y'), try_strptime(d, '%Y-%m-%d')), '%Y-%m-%d') AS d FROM mixed"""))
def _(t):
    k, award = F.col("resource_id").cast("bigint"), F.col("awarddate")
    mixed = (
        F.when(k % 4 == 0, F.col("published")).when(k % 4 == 1, award).when(k % 4 == 2, F.replace(award, F.lit("/"), F.lit("-")))
        .otherwise(F.concat_ws("-", F.substring(award, 7, 4), F.substring(award, 4, 2), F.substring(award, 1, 2)))
    )
    return t.raw_notices.select(k.alias("resource_id"), clean.parse_date(mixed).alias("d"))


MONEY_SQL = "TRY_CAST(translate(regexp_extract(value, '[€£$]?[0-9,]+\\.?[0-9]*'), '€£$,', '') AS DECIMAL(18,2))"


@query("parse_money", with_(NOTICES, RAW_NOTICES, select=f"""
SELECT resource_id, CAST({MONEY_SQL} AS DOUBLE) AS value FROM raw_notices"""))
def _(t):
    return t.raw_notices.select("resource_id", clean.parse_money("value").alias("value"))


@query("type_records", with_(NOTICES, RAW_NOTICES, select=f"""
SELECT coalesce(TRY_CAST(resource_id AS BIGINT), 0) AS resource_id, title, ca, info,
 strftime(try_strptime(published, '%d/%m/%Y %H:%M:%S'), {FMT}) AS published,
 strftime(try_strptime(deadline, '%d/%m/%Y %H:%M:%S'), {FMT}) AS deadline, procedure, status, pdf_url,
 strftime(try_strptime(awarddate, '%d/%m/%Y'), '%Y-%m-%d') AS awarddate, CAST({MONEY_SQL} AS DOUBLE) AS value,
 cycle, CAST(NULL AS BIGINT) AS bid FROM raw_notices"""))
def _(t):
    return clean.type_records(t.raw_notices)


@query("build_url", with_(NOTICES, RAW_NOTICES, select="""
SELECT resource_id, concat('https://example.org/notice?id=', resource_id) AS url,
 CASE WHEN awarddate <> '' THEN concat('https://example.org/notice?id=', resource_id) ELSE '' END AS url_v2 FROM raw_notices"""))
def _(t):
    return t.raw_notices.select(
        "resource_id", clean.build_url("resource_id", URL_BASE).alias("url"),
        clean.build_url("resource_id", URL_BASE, F.col("awarddate")).alias("url_v2"),
    )


@query("migrate_dates", with_(NOTICES, select=f"""
SELECT resource_id, CASE WHEN resource_id%11=0 THEN NULL ELSE strftime(published, {FMT}) END AS published,
 CASE WHEN resource_id%13=0 THEN NULL ELSE strftime(deadline, '%Y-%m-%d') END AS deadline_day FROM notices"""))
def _(t):
    key = F.col("resource_id")
    stored = lambda c: F.concat(F.date_format(c, "EEE MMM d HH:mm:ss"), F.lit(" IST "), F.date_format(c, "yyyy"))
    old = t.notices.select(
        key, F.when(key % 11 == 0, "").otherwise(stored("published")).alias("published"),
        F.when(key % 13 == 0, F.date_format("deadline", "dd/MM/yyyy")).otherwise(stored("deadline")).alias("deadline"),
    )
    return old.select(
        key, clean.migrate_timestamp("published").alias("published"), clean.migrate_date("deadline").alias("deadline_day")
    )


@query("migrate_money", with_(NOTICES, RAW_NOTICES, select="""
SELECT resource_id, CASE WHEN regexp_matches(value, '^[€£]?[0-9,]+\\.?[0-9]*$')
 THEN CAST(TRY_CAST(translate(value, '€£,', '') AS DECIMAL(15,2)) AS DOUBLE) END AS value FROM raw_notices"""))
def _(t):
    return t.raw_notices.select("resource_id", clean.migrate_money("value").alias("value"))


@query("migrate_label", with_(NOTICES, select="SELECT resource_id, CAST(bid AS BIGINT) AS bid FROM notices"))
def _(t):
    return t.notices.select("resource_id", clean.migrate_label(F.col("bid") == 1).alias("bid"))


@query("rollback_types", with_(NOTICES, select=f"""
SELECT resource_id, strftime(published, {FMT}) AS published, strftime(deadline, {FMT}) AS deadline,
 CAST(value AS VARCHAR) AS value FROM notices"""))
def _(t):
    df = t.notices.select("resource_id", "published", "deadline", "value")
    return clean.rollback_types(df, ["published", "deadline", "value"])


# -- text measures --------------------------------------------------------------------------------

JOINED = """joined AS (SELECT n.*, coalesce(c.pdf_text, '') AS pdf_text, coalesce(c.codes_count, 0) AS codes_count
 FROM notices n LEFT JOIN coded c USING (resource_id))"""


def _with_sizes(t):
    """Notices with the sizes of their text, taken where the text is read."""
    return t.notices.join(text.text_sizes(t.doc_content), "resource_id", "left")


def _joined(t):
    return search.scan_notices_with_text(t.notices, t.coded)


@query("text_features", with_(NOTICES, DOCS, HITS, JOINED, select=r"""
SELECT resource_id, length(title) AS title_length, len(regexp_extract_all(title, '\S+')) AS title_word_count,
 length(pdf_text) AS pdf_text_length, len(regexp_extract_all(pdf_text, '\S+')) AS pdf_text_word_count FROM joined"""))
def _(t):
    return text.text_features(t.measured).select(
        "resource_id", "title_length", "title_word_count", "pdf_text_length", "pdf_text_word_count"
    )


@query("text_ratios", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, round(length(pdf_text)::DOUBLE / (length(title) + 1), 14) AS pdf_to_title_ratio,
 round(codes_count::DOUBLE / (length(pdf_text) / 1000.0 + 1), 14) AS code_density FROM joined"""))
def _(t):
    return text.text_features(t.measured).select("resource_id", "pdf_to_title_ratio", "code_density")


@query("presence_flags", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, CASE WHEN length(trim(pdf_url)) > 0 THEN 1 ELSE 0 END AS has_pdf,
 CASE WHEN length(trim(pdf_text, E' \\t\\n\\r')) > 0 THEN 1 ELSE 0 END AS has_pdf_content,
 CASE WHEN codes_count > 0 THEN 1 ELSE 0 END AS has_codes FROM joined"""))
def _(t):
    return text.presence_flags(t.measured).select("resource_id", "has_pdf", "has_pdf_content", "has_codes")


@query("contains_year", with_(NOTICES, select="""
SELECT resource_id, CASE WHEN regexp_matches(title, '\\b20\\d{2}\\b') THEN 1 ELSE 0 END AS contains_year FROM notices"""))
def _(t):
    return t.notices.select("resource_id", clean.contains_year("title").alias("contains_year"))


@query("combined_text", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, lower(concat(title, ' ', pdf_text)) AS combined FROM joined"""))
def _(t):
    return _joined(t).select("resource_id", text.combined_text("title", "pdf_text").alias("combined"))


@query("section_extract", """
WITH d AS (SELECT doc_id, regexp_replace(text, '[0-9]', '#', 'g') AS body, lang FROM documents)
SELECT doc_id, CASE WHEN doc_id%3=0 THEN concat(E'5 Lot one\n', lang, E'\n5.1 terms')
 WHEN doc_id%3=1 THEN concat(E'5.1 first ', lang, E'\nand more\n5.2 second') ELSE '' END AS section FROM d""")
def _(t):
    key, body = F.col("doc_id"), F.regexp_replace("text", "[0-9]", "#")
    lot = F.concat(F.lit("1 Intro\n"), body, F.lit("\n 5 Lot one\n"), F.col("lang"), F.lit("\n5.1 terms \n6 Rest\n"), body)
    parts = F.concat(body, F.lit("\n5.1 first "), F.col("lang"), F.lit("\nand more\n5.2 second\n\n6.1 other\n"), body)
    made = F.when(key % 3 == 0, lot).when(key % 3 == 1, parts).otherwise(body)
    return t.raw("documents").select(key, text.extract_section(made).alias("section"))


@query("truncate_text", """
SELECT doc_id, CASE WHEN strlen(text) <= 500 THEN text ELSE concat(left(text, CAST(list_max(
 list_filter(range(125, 501), lambda k: strlen(left(text, CAST(k AS INTEGER))) <= 500)) AS INTEGER)), '...') END AS cut FROM documents""")
def _(t):
    return t.raw("documents").select("doc_id", text.truncate_bytes("text", 500).alias("cut"))


# -- codes and authorities ------------------------------------------------------------------------

@query("load_code_dictionary", """
SELECT CAST(72000000 + p_partkey AS VARCHAR) AS code, p_partkey AS code_pos FROM part WHERE p_partkey % 10 <> 0""")
def _(t):
    key = F.col("p_partkey")
    line = F.when(key % 10 == 0, " ,no code").otherwise(
        F.concat(F.lit(" "), (key + 72000000).cast("string"), F.lit(" ,"), F.col("p_name"), F.lit(", more"))
    )
    return store.parse_dictionary(t.raw("part").select(line.alias("value"), key), position=key)


@query("detect_codes", with_(DOCS, HITS, select="""
SELECT resource_id, array_to_string(detected_codes, '|') AS detected_codes, codes_count FROM coded"""))
def _(t):
    return t.coded.select("resource_id", "detected_codes", "codes_count")


@query("detect_codes_joined", with_(DOCS, HITS, select="""
SELECT resource_id, array_to_string(detected_codes, '|') AS detected_codes, codes_count FROM coded"""))
def _(t):
    """The same, with the texts left out of the join."""
    return detect_codes(t.doc_content, t.dictionary, keep=lambda docs: docs.select("resource_id", "_text_key"))


AUTH = """auth AS (SELECT n_name AS name, n_nationkey + 1 AS code FROM nation WHERE n_nationkey < 10),
ca_codes AS (SELECT ca, coalesce((SELECT min(code) FROM auth WHERE name = ca),
  (SELECT min(code) FROM auth WHERE contains(ca, name) OR contains(name, ca)),
  CAST(CAST(concat('0x', substr(md5(ca), 1, 8)) AS BIGINT) % 90 + 11 AS INTEGER))::DOUBLE AS ca_encoded
 FROM (SELECT n_name AS ca FROM nation))"""


@query("encode_authority", with_(NOTICES, AUTH, select="""
SELECT resource_id, ca, ca_encoded FROM notices JOIN ca_codes USING (ca)"""))
def _(t):
    return t.notices.select("resource_id", "ca", lexicon.encode_authority("ca", t.authorities).alias("ca_encoded"))


# -- lexicon and score ----------------------------------------------------------------------------

def _count(term: str) -> str:
    return f"len(list_filter(toks, lambda x: x = '{term}'))"


FEATURES = f"""words AS (SELECT *, len(regexp_extract_all(txt, '\\S+')) AS n_words, regexp_split_to_array(txt, {TOKENS}) AS toks
 FROM (SELECT *, lower(concat(title, ' ', pdf_text)) AS txt FROM joined)),
counted AS (SELECT *, {", ".join(f"{_count(t)} AS count_{t}" for t in TERMS)},
 1.0::DOUBLE * ({" + ".join(f"{3 if t in TEST_LEXICON.heavy_terms else 1} * {_count(t)}" for t in TEST_LEXICON.terms)})
 + 1.5 * ({" + ".join(f"(length(txt) - length(replace(txt, '{p}', ''))) // {len(p)}" for p in TEST_LEXICON.phrases)}) AS points
 FROM words),
features AS (SELECT resource_id, title, pdf_text, ca, status, procedure, value, deadline, pdf_url, n_words,
 codes_count::DOUBLE AS codes_count, CASE WHEN codes_count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_codes,
 length(title)::DOUBLE AS title_length, ca_encoded,
 CASE WHEN n_words > 0 THEN least(points / n_words * 50, 15) ELSE 0 END::DOUBLE AS exclusion_score,
 {", ".join(f"count_{t}" for t in TERMS)},
 {", ".join(f"CASE WHEN n_words > 0 THEN least(count_{t}::DOUBLE / n_words * {w}, 1) ELSE 0 END::DOUBLE AS tfidf_{t}" for t, w in TEST_LEXICON.key_terms.items())}
 FROM counted JOIN ca_codes USING (ca))"""
BASE = (NOTICES, DOCS, HITS, JOINED, AUTH, FEATURES)


def norm_sql(name: str) -> str:
    scale = fv.FEATURE_SCALES.get(name)
    return name if scale is None else f"least({name} / {scale}, 1.0)"


def weighted_sql(names, weights) -> str:
    return " + ".join(f"{norm_sql(n)} * ({w}::DOUBLE)" for n, w in zip(names, weights))


W = fv.FEATURE_WEIGHTS
SCORES = f"""scores AS (SELECT *, 1.0::DOUBLE / (1.0 + exp(-6.0 * ({weighted_sql(NAMES, W)}))) AS score,
 CASE WHEN exclusion_score > 1.0 THEN 0.054::DOUBLE * (1.0 + exclusion_score * 0.5) ELSE 0.054 END AS lim FROM features),
decided AS (SELECT *, CASE WHEN length(trim(pdf_text, E' \\t\\n\\r')) = 0 THEN 'ROUTING_ERROR' WHEN exclusion_score > 4.0 THEN 'HARD_EXCLUSION'
 WHEN exclusion_score > 2.0 AND codes_count = 0 THEN 'SOFT_EXCLUSION' ELSE 'SCORED' END AS decision FROM scores),
answers AS (SELECT *, decision = 'SCORED' AND score >= lim AS should_bid FROM decided),
reasons AS (SELECT *, concat_ws(', ',
  CASE WHEN exclusion_score > 3.0 THEN concat('🚫 VERY HIGH EXCLUSION: ', printf('%.1f', exclusion_score), ' - strong non-IT project indicators')
   WHEN exclusion_score > 2.0 THEN concat('⚠️ High exclusion score: ', printf('%.1f', exclusion_score), ' - contains non-IT terms')
   WHEN exclusion_score > 1.0 THEN concat('⚠️ Medium exclusion score: ', printf('%.1f', exclusion_score), ' - some non-IT terms') END,
  CASE WHEN codes_count > 0 THEN concat('✅ ', CAST(CAST(codes_count AS INTEGER) AS VARCHAR), ' relevant IT codes detected') ELSE '❌ No IT codes detected' END,
  CASE WHEN tfidf_{TERMS[0]} > 0.1 THEN '✅ Software-related terms found' END,
  CASE WHEN tfidf_{TERMS[1]} > 0.1 THEN '✅ Support service terms found' END,
  CASE WHEN title_length > 100 THEN '✅ Detailed title indicates complex requirements' END) AS why FROM answers),
predicted AS (SELECT *,
 CASE WHEN decision <> 'ROUTING_ERROR' THEN should_bid END AS ml_bid,
 CASE decision WHEN 'SCORED' THEN score WHEN 'SOFT_EXCLUSION' THEN 0.01 ELSE 0.0 END::DOUBLE AS ml_confidence,
 CASE WHEN decision = 'ROUTING_ERROR' THEN 'routing_error' WHEN should_bid THEN 'bid' ELSE 'no-bid' END AS ml_status,
 CASE decision
  WHEN 'HARD_EXCLUSION' THEN concat('HARD_EXCLUSION: Score ', printf('%.1f', exclusion_score), ' - Strong non-IT indicators (construction/infrastructure/civil engineering). Automatically excluded.')
  WHEN 'SOFT_EXCLUSION' THEN concat('SOFT_EXCLUSION: Score ', printf('%.1f', exclusion_score), ' with no IT codes - Likely non-IT project without relevant codes.')
  WHEN 'SCORED' THEN concat(CASE WHEN should_bid AND score > 0.2 THEN 'HIGH_CONFIDENCE_BID' WHEN should_bid AND score > 0.1 THEN 'MEDIUM_CONFIDENCE_BID'
    WHEN should_bid THEN 'LOW_CONFIDENCE_BID' WHEN exclusion_score > 2.0 THEN 'EXCLUDED_NON_IT' ELSE 'NO_BID_RECOMMENDED' END,
   ': ', why, ' (Score: ', printf('%.0f', score * 100), '%',
   CASE WHEN lim <> 0.054 THEN concat(' (adjusted threshold: ', printf('%.0f', lim * 100), '%)') ELSE '' END, ')') END AS ml_reasoning FROM reasons)"""


def _features(t):
    return scoring.feature_vector(t.screened, TEST_LEXICON, t.authorities)


def _predicted(t):
    return scoring.predict_rule(t.screened, TEST_LEXICON, t.authorities)


def _predicted_with_text(t):
    """For messages and prompts, which carry the text on."""
    return scoring.predict_rule(_joined(t), TEST_LEXICON, t.authorities)


@query("term_counts", with_(*BASE, select=f"SELECT resource_id, n_words, {', '.join(f'count_{t}' for t in TERMS)} FROM features"))
def _(t):
    return lexicon.lexicon_features(t.screened, TEST_LEXICON).select("resource_id", "n_words", *[f"count_{x}" for x in TERMS])


@query("term_scores", with_(*BASE, select=f"""
SELECT resource_id, {', '.join(f'round(tfidf_{t}, 14) AS tfidf_{t}' for t in TERMS)} FROM features"""))
def _(t):
    return lexicon.lexicon_features(t.screened, TEST_LEXICON).select("resource_id", *[f"tfidf_{x}" for x in TERMS])


@query("exclusion_score", with_(*BASE, select="SELECT resource_id, round(exclusion_score, 14) AS exclusion_score FROM features"))
def _(t):
    return lexicon.lexicon_features(t.screened, TEST_LEXICON).select("resource_id", "exclusion_score")


@query("feature_vector", with_(*BASE, select=f"SELECT resource_id, {', '.join(f'round({n}, 14) AS {n}' for n in NAMES)} FROM features"))
def _(t):
    return _features(t).select("resource_id", *NAMES)


@query("normalize_features", with_(*BASE, select=f"""
SELECT resource_id, {', '.join(f'round({norm_sql(n)}, 14) AS {n}' for n in NAMES)} FROM features"""))
def _(t):
    return scoring.normalize_features(_features(t), NAMES).select("resource_id", *NAMES)


@query("linear_score", with_(*BASE, SCORES, select="SELECT resource_id, round(score, 14) AS score FROM scores"))
def _(t):
    return _features(t).select("resource_id", scoring.linear_score(NAMES).alias("score"))


@query("predict_rule", with_(*BASE, SCORES, select="""
SELECT resource_id, title, decision, round(exclusion_score, 14) AS exclusion_score, ml_bid, round(ml_confidence, 14) AS ml_confidence,
 ml_status, ml_reasoning FROM predicted"""))
def _(t):
    return _predicted(t).select(
        "resource_id", "title", "decision", "exclusion_score", "ml_bid", "ml_confidence", "ml_status", "ml_reasoning"
    )


@query("reason_text", with_(*BASE, SCORES, select="SELECT resource_id, ml_reasoning FROM predicted WHERE decision <> 'ROUTING_ERROR'"))
def _(t):
    return _predicted(t).where(F.col("decision") != "ROUTING_ERROR").select("resource_id", "ml_reasoning")


@query("component_scores", with_(*BASE, select=f"""
SELECT resource_id, round({norm_sql('codes_count')} * 0.25, 14) AS codes_count_score, round(has_codes * 0.10, 14) AS has_codes_score,
 round({norm_sql('title_length')} * 0.02, 14) AS title_length_score, round({norm_sql('ca_encoded')} * 0.03, 14) AS ca_score,
 round({weighted_sql(NAMES[4:14], W[4:14])}, 14) AS text_features_score, round({weighted_sql(NAMES, W)}, 14) AS total_score FROM features"""))
def _(t):
    return _features(t).select("resource_id", scoring.component_scores(NAMES).alias("s")).select("resource_id", "s.*")


@query("route_by_length", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, CASE WHEN pdf_url = '' OR strlen(trim(pdf_text, E' \\t\\n\\r')) < 100 THEN 'ai_summary_title_only' ELSE 'ml_prediction' END AS stage,
 CASE WHEN pdf_url <> '' AND strlen(trim(pdf_text, E' \\t\\n\\r')) < 100 THEN 'ai_summary_title_only' ELSE 'ml_prediction' END AS strict_stage FROM joined"""))
def _(t):
    rows = _with_sizes(t)
    return rows.select(
        "resource_id", scoring.route_by_size("trimmed_bytes", "pdf_url").alias("stage"),
        scoring.route_by_size("trimmed_bytes", "pdf_url", strict=True).alias("strict_stage"),
    )


REVIEW = """review AS (SELECT resource_id, title, has, has AND p >= 0.05 AS yes, CASE WHEN has THEN p END AS p FROM
 (SELECT resource_id, title, ml_confidence AS p, length(trim(pdf_text, E' \\t\\n\\r')) > 50 AS has FROM predicted)),
categories AS (SELECT *, CASE WHEN NOT has THEN 'NO_PDF_DATA' WHEN yes THEN 'ML_PREDICTED_BID' ELSE 'ML_PREDICTED_NO_BID' END AS category FROM review)"""


def _reviewed(t):
    return scoring.review_category(_predicted(t), "ml_confidence")


@query("review_category", with_(*BASE, SCORES, REVIEW, select="""
SELECT resource_id, category, CASE category WHEN 'NO_PDF_DATA' THEN 'MANUAL_REVIEW' WHEN 'ML_PREDICTED_BID' THEN 'LLM_SUMMARY_REQUIRED' ELSE 'LOW_PRIORITY_REVIEW' END AS action,
 CASE category WHEN 'NO_PDF_DATA' THEN 'HIGH' WHEN 'ML_PREDICTED_BID' THEN 'URGENT' ELSE 'LOW' END AS priority,
 CASE category WHEN 'NO_PDF_DATA' THEN concat('⚠️ Manual Review Required: ''', title, ''' - No PDF data available for ML analysis')
  WHEN 'ML_PREDICTED_BID' THEN concat('🎯 ACTION REQUIRED: ''', title, ''' - ML predicts BID opportunity (', printf('%.1f', p * 100), '% confidence)')
  ELSE concat('📋 Low Priority: ''', title, ''' - ML suggests no bid (', printf('%.1f', p * 100), '% confidence)') END AS message,
 round(p, 14) AS ml_probability, yes AS requires_summary FROM categories"""))
def _(t):
    return _reviewed(t).select("resource_id", "category", "action", "priority", "message", "ml_probability", "requires_summary")


@query("category_volumes", with_(*BASE, SCORES, REVIEW, select="""
SELECT category, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM categories GROUP BY category"""))
def _(t):
    return monitor.category_volumes(_reviewed(t))


@query("signed_confidence", with_(*BASE, SCORES, select="""
SELECT resource_id, round(CASE WHEN ml_confidence >= 0.21 THEN ml_confidence ELSE 1.0 - ml_confidence END, 14) AS confidence FROM predicted"""))
def _(t):
    return _predicted(t).select("resource_id", scoring.signed_confidence("ml_confidence").alias("confidence"))


@query("message_priority", with_(*BASE, SCORES, select="""
SELECT resource_id, CASE WHEN ml_bid THEN 'URGENT' ELSE 'NORMAL' END AS priority FROM predicted"""))
def _(t):
    return _predicted(t).select("resource_id", scoring.message_priority("ml_bid").alias("priority"))


@query("scored_message", with_(*BASE, SCORES, select="""
SELECT resource_id, title AS tender_title, ml_bid AS should_bid, round(ml_confidence, 6) AS confidence, strlen(pdf_text) AS text_bytes,
 CASE WHEN ml_bid THEN 'URGENT' ELSE 'NORMAL' END AS priority FROM predicted"""))
def _(t):
    sent = messages.scored_message(_predicted_with_text(t), F.lit(AS_OF).cast("timestamp_ntz"))
    # Read back in one go; a path for each field would walk the whole text each time.
    fields = "resource_id string, tender_title string, ml_prediction struct<should_bid:boolean,confidence:double>, pdf_content string, priority string"
    read = sent.select(F.explode(F.array(F.from_json("body", fields))).alias("m"))
    return read.select(
        F.col("m.resource_id").cast("bigint").alias("resource_id"), "m.tender_title", "m.ml_prediction.should_bid",
        F.round("m.ml_prediction.confidence", 6).alias("confidence"), F.octet_length("m.pdf_content").alias("text_bytes"), "m.priority",
    )


@query("summary_type", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, CASE WHEN strlen(pdf_text) < 100 THEN 'TITLE_ONLY' ELSE 'FULL_PDF' END AS summary_type FROM joined"""))
def _(t):
    return _with_sizes(t).select("resource_id", scoring.summary_type_of("text_bytes").alias("summary_type"))


@query("title_only_message", with_(NOTICES, DOCS, HITS, JOINED, select="""
SELECT resource_id, concat('{"resource_id":"', resource_id, '","tender_title":"', title, '","ml_prediction":{"should_bid":false,"confidence":0.0,',
 '"reasoning":"Title-only analysis - no PDF content available","feature_scores":{"codes_count_score":0.0,"has_codes_score":0.0,',
 '"title_length_score":0.0,"ca_score":0.0,"text_features_score":0.0,"total_score":0.0}},"pdf_content":"","priority":"NORMAL",',
 '"timestamp":"2001-08-01T00:00:00Z"}') AS body FROM joined WHERE pdf_url = '' OR pdf_text = ''"""))
def _(t):
    rows = _with_sizes(t).where((F.col("pdf_url") == "") | (F.coalesce("text_bytes", F.lit(0)) == 0)).withColumn("pdf_text", F.lit(""))
    return messages.title_only_message(rows, F.lit(AS_OF).cast("timestamp_ntz")).select("resource_id", "body")


def _template_sql(template: str, fields: dict[str, str]) -> str:
    """The template as a SQL concat, for the oracle."""
    out = "'" + template.replace("'", "''") + "'"
    for name, sql in fields.items():
        out = out.replace("{" + name + "}", f"', {sql}, '")
    return f"concat({out})"


PROMPT_FIELDS = {
    "title": "title", "ca": "ca", "value": "coalesce(CAST(value AS VARCHAR), 'Not specified')",
    "deadline": f"coalesce(strftime(deadline, {FMT}), 'Not specified')", "status": "status", "procedure": "procedure",
    "text": "cut", "codes": "codes", "codes_count": "CAST(CAST(codes_count AS INTEGER) AS VARCHAR)",
    "verdict": "CASE WHEN ml_bid THEN 'RECOMMEND BID' ELSE 'DO NOT BID' END", "confidence": "printf('%.1f', ml_confidence * 100)",
    "reasoning": "coalesce(ml_reasoning, '')", "scope": "'software and support'",
}


@query("prompt_table", with_(*BASE, SCORES, """
cuts AS (SELECT p.*, coalesce(array_to_string(c.detected_codes, ', '), '') AS codes, CASE WHEN strlen(p.pdf_text) <= 15000 THEN p.pdf_text
 ELSE concat(left(p.pdf_text, CAST(list_max(list_filter(range(3750, 15001), lambda k: strlen(left(p.pdf_text, CAST(k AS INTEGER))) <= 15000)) AS INTEGER)), '...[TRUNCATED]') END AS cut
 FROM predicted p LEFT JOIN coded c USING (resource_id))""", select=f"""
SELECT resource_id, md5(CASE WHEN strlen(pdf_text) < 100 THEN {_template_sql(reply.TITLE_PROMPT, PROMPT_FIELDS)}
 ELSE {_template_sql(reply.FULL_PROMPT, PROMPT_FIELDS)} END) AS prompt_md5 FROM cuts"""))
def _(t):
    rows = _predicted_with_text(t).withColumns({
        "summary_type": scoring.summary_type("pdf_text"), "should_bid": F.coalesce("ml_bid", F.lit(False)),
        "confidence": F.col("ml_confidence"), "reasoning": F.col("ml_reasoning"),
    })
    prompts = reply.prompt_table(rows, "software and support", max_bytes=15000)
    return prompts.select("resource_id", F.md5("prompt").alias("prompt_md5"))
