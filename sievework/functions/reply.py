"""Model replies in, notifications out: parsing, decisions, payloads and the text digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework import schemas
from sievework.functions import clean
from sievework.functions.clean import _c, trim_all
from sievework.functions.text import truncate_bytes

def _strings() -> Column:
    return F.array().cast("array<string>")


def _literals(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


# -- reading a reply ------------------------------------------------------------------------------

def balanced_block(c: Column) -> Column:
    """From the first ``{`` to the brace that closes it; NULL when there is none.

    The text is cut after each brace, so the fold takes one step per brace, not per character.
    The last piece may end without one; a pattern that insisted on a brace would search the rest
    of the text anew from each of its characters.
    """
    start = F.instr(c, "{")
    tail = F.substr(c, start, F.length(c))
    pieces = F.regexp_extract_all(tail, F.lit(r"[^{}]*+(?:[{}]|\z)"), F.lit(0))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("closed"))

    def step(state: Column, piece: Column) -> Column:
        depth = state["depth"] + F.when(piece.endswith("{"), 1).when(piece.endswith("}"), -1).otherwise(0)
        moved = F.struct(
            depth.alias("depth"), (state["taken"] + F.length(piece)).alias("taken"), (piece.endswith("}") & (depth == 0)).alias("closed")
        )
        return F.when(state["closed"], state).otherwise(moved)

    end = F.aggregate(pieces, zero, step)
    return F.when((start > 0) & end["closed"], F.substr(tail, F.lit(1), end["taken"]))


def extract_json(c: Column | str) -> Column:
    """The JSON part of a reply: all of it, a fenced block, the first balanced braces, else the reply."""
    c = _c(c)
    whole = trim_all(c)
    fence = r"(?s)```json\s*(.*?)```"
    return (
        F.when(whole.startswith("{") & whole.endswith("}"), whole)
        .when(c.rlike(fence), trim_all(F.regexp_extract(c, fence, 1)))
        .otherwise(F.coalesce(balanced_block(c), c))
    )


def strict_json(c: Column) -> Column:
    """The text as one JSON value; NULL if it is not exactly one."""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    alone = F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def text_at(value: Column, path: str) -> Column:
    """A JSON string at ``path``; NULL for anything that is not a string."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(value, path, "string"))


def texts_at(value: Column, path: str) -> Column:
    """The strings of a JSON list at ``path``; NULL when it is not a list."""
    found = F.try_variant_get(value, path, "array<variant>")
    only = F.filter(found, lambda e: F.schema_of_variant(e) == "STRING")
    return F.transform(only, lambda e: F.try_variant_get(e, "$", "string"))


def recommend_from_text(c: Column | str) -> Column:
    """Recommendation of a plain-text reply, first matching phrase wins (F32)."""
    low = F.lower(_c(c))
    any_of = lambda words: F.exists(_literals(words), lambda w: low.contains(w))
    return (
        F.when(any_of(("recommend bid", "should bid")), "BID")
        .when(any_of(("no bid", "don't bid", "do not bid")), "NO BID")
        .when(any_of(fv.IT_INDICATORS), "BID - IT opportunity identified")
        .otherwise(fv.RECOMMENDATION_FALLBACK)
    )


def processing_notes(
    reply: Column, summary: Column, recommendation: Column,
    indicators: Sequence[str] = fv.NON_IT_INDICATORS, patterns: Sequence[str] = fv.NO_BID_PATTERNS,
) -> Column:
    """Notes on a parsed reply: override, each indicator found, no-bid wording."""
    both = F.concat(F.lower(summary), F.lit(" "), F.lower(recommendation))
    found = F.filter(_literals(indicators), lambda w: both.contains(w))
    no_bid = F.exists(_literals(patterns), lambda w: both.contains(w))
    return F.concat(
        F.array(F.lit(fv.NOTE_PARSED)),
        F.when(F.lower(reply).contains("overrid") | F.lower(reply).contains("override"), F.array(F.lit(fv.NOTE_OVERRIDE)))
        .otherwise(_strings()),
        F.transform(found, lambda w: F.concat(F.lit(fv.NOTE_INDICATOR), w)),
        F.when(no_bid, F.array(F.lit(fv.NOTE_NO_BID))).otherwise(_strings()),
    )


def normalize_reply(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Summary columns from each reply; a reply that is no JSON becomes a plain-text summary."""
    text = F.col(reply)
    # Generated, not projected: a filter on the summary is then not rewritten into copies of the
    # parsing expression, which would run once per mention.
    step = df.withColumn("_json", F.explode(F.array(strict_json(extract_json(text)))))
    value, parsed = F.col("_json"), F.col("_json").isNotNull()
    step = step.withColumns({
        "ai_summary": F.when(parsed, F.coalesce(text_at(value, "$.summary"), text)).otherwise(text),
        "key_points": F.when(
            parsed, F.coalesce(texts_at(value, "$.key_points"), F.array(F.lit(fv.KEY_POINTS_MISSING)))
        ).otherwise(F.array(F.lit(fv.KEY_POINTS_PLAIN))),
        "recommendation": F.when(
            parsed, F.coalesce(text_at(value, "$.recommendation"), F.lit(fv.RECOMMENDATION_MISSING))
        ).otherwise(recommend_from_text(text)),
        "confidence_assessment": F.when(
            parsed, F.coalesce(text_at(value, "$.confidence_assessment"), F.lit(fv.CONFIDENCE_MISSING))
        ).otherwise(fv.CONFIDENCE_PLAIN),
    })
    return step.withColumn(
        "processing_notes",
        F.when(parsed, processing_notes(text, F.col("ai_summary"), F.col("recommendation")))
        .otherwise(F.array(F.lit(fv.NOTE_PLAIN))),
    ).drop("_json")


# -- deciding and notifying -----------------------------------------------------------------------

def _noted(*words: str) -> Column:
    found = lambda n: n.contains(words[0]) if len(words) == 1 else (n.contains(words[0]) | n.contains(words[1]))
    return F.exists("processing_notes", found)


def should_notify(strict: bool = False, min_confidence: float | None = None) -> Column:
    """Whether a summary leads to a notification.

    Reads ``recommendation``, ``processing_notes``, ``should_bid`` and, with a limit,
    ``confidence``. "do not bid" holds "bid" and counts as a bid unless ``strict``.
    """
    low = F.lower("recommendation")
    fallback = (F.col("recommendation") == fv.RECOMMENDATION_FALLBACK) & _noted("could not be parsed as JSON")
    says_bid = low.contains("bid") & ~low.contains("no bid")
    if strict:
        says_bid = says_bid & ~F.exists(_literals(fv.NO_BID_PATTERNS), lambda w: low.contains(w))
    decision = F.when(fallback, F.col("should_bid")).otherwise(says_bid)
    return decision if min_confidence is None else decision & (F.col("confidence") >= min_confidence)


def with_notify_note(df: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``notify`` and the note that says so."""
    marked = df.withColumn("notify", should_notify(strict))
    note = F.when(F.col("notify"), fv.NOTE_SENT).otherwise(fv.NOTE_SUPPRESSED)
    return marked.withColumn("processing_notes", F.concat("processing_notes", F.array(note)))


def notify_priority() -> Column:
    """Priority of a notification (F35); reads the notes, the prediction and the summary type."""
    override, concern = _noted("OVERRODE", "overrode"), _noted("NON-IT INDICATOR")
    bid = F.col("should_bid")
    return (
        F.when(override & bid, "CRITICAL").when(bid & ~concern, "URGENT").when(concern, "MEDIUM")
        .when(F.col("summary_type") == "FULL_PDF", "HIGH").otherwise("NORMAL")
    )


def notify_action() -> Column:
    override, concern = _noted("OVERRODE", "overrode"), _noted("NON-IT INDICATOR")
    bid = F.col("should_bid")
    return (
        F.when(override & bid, fv.ACTION_CRITICAL).when(bid, fv.ACTION_URGENT).when(concern, fv.ACTION_MEDIUM)
        .otherwise(fv.ACTION_DEFAULT)
    )


def notify_payload(df: DataFrame, now: Column, link_base: str) -> DataFrame:
    """``df`` plus ``payload``: the notification as JSON with its nested metadata."""
    key = F.col("resource_id")
    metadata = F.struct(
        key, F.col("ca").alias("contracting_authority"),
        F.col("value").cast("string").alias("estimated_value"),
        F.date_format("deadline", "yyyy-MM-dd'T'HH:mm:ss").alias("deadline"),
        "summary_type",
        _noted("OVERRODE", "overrode").alias("claude_override"),
        _noted("NON-IT INDICATOR").alias("has_non_it_indicators"),
        "processing_notes", F.lit(True).alias("notification_sent"),
        F.struct("should_bid", "confidence", "reasoning").alias("ml_prediction"),
        "ml_status", "ml_processed", "ai_summary", "key_points", "recommendation", "confidence_assessment",
        "pdf_url", "status", "procedure",
        F.concat(F.lit(link_base), key.cast("string")).alias("portal_link"),
    )
    return df.withColumn("payload", F.to_json(F.struct(
        F.lit("AI_SUMMARY_COMPLETE").alias("message_type"), key.cast("string").alias("resource_id"), "title",
        notify_priority().alias("priority"), F.col("ai_summary").alias("summary"),
        notify_action().alias("action_required"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), metadata.alias("metadata"),
    )))


def digest_rows(df: DataFrame, link_base: str, payload: str = "payload") -> DataFrame:
    """The fields of a digest read back from the payload, with their defaults.

    The metadata may be a JSON object or a string that holds one.
    """
    step = df.withColumn("_m", F.from_json(payload, schemas.NOTIFICATION))
    step = step.withColumn("_v", F.try_parse_json("_m.metadata"))
    meta = F.col("_v")
    number = F.try_variant_get(meta, "$.ml_prediction.confidence", "variant")
    numeric = ~F.schema_of_variant(number).isin("STRING", "BOOLEAN", "VOID")
    confidence = F.when(numeric, F.try_variant_get(meta, "$.ml_prediction.confidence", "double"))
    default = lambda path, other: F.coalesce(text_at(meta, path), other if isinstance(other, Column) else F.lit(other))
    stamp = F.date_format(clean.utc_time("_m.timestamp"), "yyyy-MM-dd HH:mm:ss")
    return step.select(
        F.lit("Tender Opportunity").alias("subject"),
        F.col("_m.resource_id").alias("resource_id"),
        F.col("_m.title").alias("title"),
        default("$.contracting_authority", "Unknown Authority").alias("contracting_authority"),
        F.col("_m.summary").alias("summary"),
        F.col("_m.priority").alias("priority"),
        F.round(confidence * 100.0).alias("prediction_confidence"),
        text_at(meta, "$.deadline").alias("deadline"),
        text_at(meta, "$.estimated_value").alias("estimated_value"),
        F.concat(stamp, F.lit(" UTC")).alias("timestamp"),
        default("$.portal_link", F.concat(F.lit(link_base), F.col("_m.resource_id"))).alias("portal_link"),
        default("$.ai_summary", F.col("_m.summary")).alias("ai_summary"),
        F.coalesce(texts_at(meta, "$.key_points"), F.array(F.lit("See summary for details"))).alias("key_points"),
        default("$.recommendation", "See summary").alias("recommendation"),
        default("$.confidence_assessment", "Assessment pending").alias("confidence_assessment"),
        text_at(meta, "$.pdf_url").alias("pdf_url"),
        text_at(meta, "$.ml_prediction.reasoning").alias("ml_reasoning"),
    )


def priority_class(c: Column | str) -> Column:
    """Urgent, High or, for everything else, Normal."""
    word = F.upper(_c(c))
    return F.when(word == "URGENT", "Urgent").when(word == "HIGH", "High").otherwise("Normal")


def valid_recipients(c: Column | str) -> Column:
    """Addresses of a comma list with one @, text before it and a dot after it."""
    trimmed = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), trim_all)
    return F.filter(trimmed, lambda e: e.rlike(r"^[^@]+@[^@]*\.[^@]*$"))


def notification_fanout(notifications: DataFrame, recipients: Column) -> DataFrame:
    """One row per notification and valid recipient; without recipients there are no rows."""
    return notifications.withColumn("recipient", F.explode(valid_recipients(recipients)))


def digest_text(heading: str = "NOTICE NOTIFICATION", footer: str = "This is an automated notification.") -> Column:
    """The digest of a row of :func:`digest_rows` as plain text; empty fields leave their section out."""
    shown = lambda c: F.coalesce(F.col(c), F.lit("")) != ""

    def line(label: str, c: Column) -> Column:
        return F.concat(F.lit(label), c)

    def section(title: str, body: Column, keep: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{title}\n{'-' * len(title)}\n"), body, F.lit("\n"))
        return text if keep is None else F.when(keep, text)

    p = F.col("prediction_confidence")
    details = F.concat_ws(
        "\n",
        line("ID: ", F.col("resource_id")), line("Title: ", F.col("title")),
        line("Contracting Authority: ", F.col("contracting_authority")), line("Priority: ", F.col("priority")),
        F.when(shown("deadline"), line("Deadline: ", F.col("deadline"))),
        F.when(shown("estimated_value"), line("Estimated Value: ", F.col("estimated_value"))),
        F.when(p.isNotNull() & (p != 0), F.concat(F.lit("Match Confidence: "), p.cast("string"), F.lit("%"))),
        line("Notification Time: ", F.col("timestamp")),
    )
    bullets = F.array_join(F.transform("key_points", lambda k: F.concat(F.lit("• "), k)), "\n")
    # The whole analysis hangs on a summary being there.
    summary = shown("ai_summary")
    return F.concat_ws(
        "\n",
        F.lit(f"{heading}\n{'=' * len(heading)}\n"),
        F.concat(F.col("subject"), F.lit("\n")),
        section("DETAILS", details),
        section("AI SUMMARY", F.col("ai_summary"), summary),
        section("KEY POINTS", bullets, summary & (F.size("key_points") > 0)),
        section("RECOMMENDATION", F.col("recommendation"), summary & shown("recommendation")),
        section("CONFIDENCE ASSESSMENT", F.col("confidence_assessment"), summary & shown("confidence_assessment")),
        section("ML ANALYSIS", F.col("ml_reasoning"), summary & shown("ml_reasoning")),
        section("VIEW FULL NOTICE", F.col("portal_link")),
        section("VIEW PDF DOCUMENT", F.col("pdf_url"), shown("pdf_url")),
        section("NOTIFICATION DETAILS", F.concat(F.lit(footer + "\nGenerated on "), F.col("timestamp"))),
    )


# -- prompts --------------------------------------------------------------------------------------

TITLE_PROMPT = """Decide from its title whether this notice fits the scope below.

TITLE: "{title}"
CONTRACTING AUTHORITY: "{ca}"
PREDICTION: {verdict} (confidence: {confidence}%)
REASONING: {reasoning}

SCOPE:
{scope}

Answer as JSON with fields: summary, key_points (array), recommendation (BID or NO BID), confidence_assessment"""

FULL_PROMPT = """Decide from its document whether this notice fits the scope below.

Title: "{title}"
Contracting Authority: "{ca}"
Value: {value}
Deadline: {deadline}
Status: "{status}"
Procedure: "{procedure}"

DOCUMENT:
{text}

DETECTED CODES: {codes}
CODES COUNT: {codes_count}

PREDICTION: {verdict} (confidence: {confidence}%)
REASONING: {reasoning}

SCOPE:
{scope}

Answer as JSON with fields: summary, key_points (array), recommendation (BID or NO BID), confidence_assessment"""


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """A ``{name}`` template as one concatenation of its pieces and columns."""
    pieces: list[Column] = []
    rest = template
    while rest:
        cuts = [(rest.find("{" + n + "}"), n) for n in fields if "{" + n + "}" in rest]
        if not cuts:
            pieces.append(F.lit(rest))
            break
        at, name = min(cuts)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(fields[name])
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces)


def prompt_table(
    df: DataFrame, scope: str, title_template: str = TITLE_PROMPT, full_template: str = FULL_PROMPT,
    max_bytes: int = 15000,
) -> DataFrame:
    """``df`` plus ``prompt``, ready for batch inference.

    Reads ``summary_type``, the notice fields, ``pdf_text``, ``detected_codes``, ``codes_count``,
    ``should_bid``, ``confidence`` and ``reasoning``. Long texts are cut at ``max_bytes``.
    """
    from sievework.operators.scoring import fixed_decimals

    unknown = F.lit("Not specified")
    fields = {
        "title": F.coalesce("title", F.lit("")), "ca": F.coalesce("ca", F.lit("")),
        "value": F.coalesce(F.col("value").cast("string"), unknown),
        "deadline": F.coalesce(F.date_format("deadline", "yyyy-MM-dd HH:mm:ss"), unknown),
        "status": F.coalesce("status", F.lit("")), "procedure": F.coalesce("procedure", F.lit("")),
        "text": truncate_bytes(F.coalesce("pdf_text", F.lit("")), max_bytes, "[TRUNCATED]"),
        "codes": F.array_join("detected_codes", ", "),
        "codes_count": F.coalesce("codes_count", F.lit(0)).cast("int").cast("string"),
        "verdict": F.when(F.col("should_bid"), "RECOMMEND BID").otherwise("DO NOT BID"),
        "confidence": fixed_decimals(F.col("confidence") * 100.0, 1),
        "reasoning": F.coalesce("reasoning", F.lit("")), "scope": F.lit(scope),
    }
    return df.withColumn(
        "prompt",
        F.when(F.col("summary_type") == "TITLE_ONLY", fill_template(title_template, fields))
        .otherwise(fill_template(full_template, fields)),
    )
