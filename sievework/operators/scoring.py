"""The rule score: features, linear score, decision, reasons, routes and review categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.functions.clean import trim_all
from sievework.operators.lexicon import Lexicon, encode_authority, lexicon_counts, lexicon_features


def fixed_decimals(c: Column, places: int) -> Column:
    """Number as text with ``places`` decimals, rounded on its exact binary value, ties to even."""
    return F.call_function("format_number", c, F.lit("0." + "0" * places if places else "0"))


def text_size(df: DataFrame) -> Column:
    """Characters of the trimmed text; read from ``text_chars`` on rows that left their text behind."""
    if "text_chars" in df.columns:
        return F.coalesce(F.col("text_chars"), F.lit(0))
    return F.length(trim_all(F.coalesce(F.col("pdf_text"), F.lit(""))))


def doc_features(docs: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """What the score needs of each document text, without the text.

    This is the narrow frame to join to the notices: the texts, by far the widest column, are
    read, counted and dropped in one scan and take no part in any shuffle.
    """
    counted = lexicon_counts(docs, "pdf_text", lexicon, "d_")
    trimmed = counted.withColumn("_trimmed", trim_all(F.coalesce(F.col("pdf_text"), F.lit(""))))
    sized = trimmed.withColumns({"text_chars": F.length("_trimmed"), "trimmed_bytes": F.octet_length("_trimmed")})
    return sized.drop("_trimmed", "pdf_text")


def feature_names(lexicon: Lexicon) -> list[str]:
    return ["codes_count", "has_codes", "title_length", "ca_encoded", "exclusion_score"] + [
        f"tfidf_{t}" for t in lexicon.key_terms
    ]


def feature_vector(
    df: DataFrame,
    lexicon: Lexicon | None = None,
    authorities: Mapping[str, int] | None = None,
    in_bytes: bool = False,
) -> DataFrame:
    """``df`` plus the 15 features as double columns (F17). ``in_bytes`` measures titles in bytes."""
    lex = lexicon or Lexicon()
    title = F.coalesce(F.col("title"), F.lit(""))
    count = F.coalesce(F.col("codes_count"), F.lit(0)).cast("double")
    scored = lexicon_features(df, lex)
    return scored.withColumns({
        "codes_count": count,
        "has_codes": F.when(count > 0, 1.0).otherwise(0.0),
        "title_length": (F.octet_length(title) if in_bytes else F.length(title)).cast("double"),
        "ca_encoded": encode_authority("ca", authorities),
    })


def normalized(name: str) -> Column:
    scale = fv.FEATURE_SCALES.get(name)
    return F.col(name) if scale is None else F.least(F.col(name) / F.lit(scale), F.lit(1.0))


def normalize_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: normalized(n) for n in names})


def _weighted(names: Sequence[str], weights: Sequence[float]) -> Column:
    """Weighted sum of the normalised features, left to right, as one expression text."""
    capped = {n: f"least(`{n}` / {scale!r}D, 1.0D)" for n, scale in fv.FEATURE_SCALES.items()}
    terms = [f"{capped.get(n, f'`{n}`')} * {w!r}D" for n, w in zip(names, weights)]
    return F.expr("0.0D + " + " + ".join(terms))


def linear_score(names: Sequence[str], weights: Sequence[float] = fv.FEATURE_WEIGHTS) -> Column:
    """Weighted sum of the normalised features through a sigmoid."""
    return 1.0 / (1.0 + F.exp(-F.lit(fv.SIGMOID_SLOPE) * _weighted(names, weights)))


def component_scores(names: Sequence[str], weights: Sequence[float] = fv.FEATURE_WEIGHTS) -> Column:
    """Contribution of the first four features, of features 5 to 14 together, and of all."""
    one = [normalized(n) * F.lit(w) for n, w in zip(names, weights)]
    return F.struct(
        one[0].alias("codes_count_score"),
        one[1].alias("has_codes_score"),
        one[2].alias("title_length_score"),
        one[3].alias("ca_score"),
        _weighted(names[4:14], weights[4:14]).alias("text_features_score"),
        _weighted(names, weights).alias("total_score"),
    )


def reason_text(names: Sequence[str], threshold: float) -> Column:
    """Why the rule decided as it did; reads ``score``, ``limit`` and ``should_bid``."""
    exclusion, codes = F.col("exclusion_score"), F.col("codes_count")
    first, second = names[5], names[6]
    density = fixed_decimals(exclusion, 1)
    percent = lambda c: F.concat(fixed_decimals(c * 100.0, 0), F.lit("%"))
    reasons = F.concat_ws(
        ", ",
        F.when(exclusion > 3.0, F.concat(F.lit("🚫 VERY HIGH EXCLUSION: "), density, F.lit(" - strong non-IT project indicators")))
        .when(exclusion > 2.0, F.concat(F.lit("⚠️ High exclusion score: "), density, F.lit(" - contains non-IT terms")))
        .when(exclusion > 1.0, F.concat(F.lit("⚠️ Medium exclusion score: "), density, F.lit(" - some non-IT terms"))),
        F.when(codes > 0, F.concat(F.lit("✅ "), codes.cast("int").cast("string"), F.lit(" relevant IT codes detected")))
        .otherwise("❌ No IT codes detected"),
        F.when(F.col(first) > 0.1, "✅ Software-related terms found"),
        F.when(F.col(second) > 0.1, "✅ Support service terms found"),
        F.when(F.col("title_length") > 100.0, "✅ Detailed title indicates complex requirements"),
    )
    category = (
        F.when(F.col("should_bid") & (F.col("score") > 0.2), "HIGH_CONFIDENCE_BID")
        .when(F.col("should_bid") & (F.col("score") > 0.1), "MEDIUM_CONFIDENCE_BID")
        .when(F.col("should_bid"), "LOW_CONFIDENCE_BID")
        .when(exclusion > 2.0, "EXCLUDED_NON_IT")
        .otherwise("NO_BID_RECOMMENDED")
    )
    adjusted = F.when(
        F.col("limit") != threshold, F.concat(F.lit(" (adjusted threshold: "), percent(F.col("limit")), F.lit(")"))
    ).otherwise("")
    return F.concat(category, F.lit(": "), reasons, F.lit(" (Score: "), percent(F.col("score")), adjusted, F.lit(")"))


def predict_rule(
    df: DataFrame,
    lexicon: Lexicon | None = None,
    authorities: Mapping[str, int] | None = None,
    threshold: float = fv.RULE_THRESHOLD,
    weights: Sequence[float] = fv.FEATURE_WEIGHTS,
) -> DataFrame:
    """Rule decision per notice.

    Adds ``ml_bid``, ``ml_confidence``, ``ml_reasoning``, ``ml_status``, ``decision`` and
    ``feature_scores``. Blank texts are not scored: status ``routing_error``, confidence 0.
    """
    lex = lexicon or Lexicon()
    return decide(feature_vector(df, lex, authorities), feature_names(lex), threshold, weights)


def decide(
    features: DataFrame,
    names: Sequence[str],
    threshold: float = fv.RULE_THRESHOLD,
    weights: Sequence[float] = fv.FEATURE_WEIGHTS,
) -> DataFrame:
    """The decision on rows that already carry their features, and their text or its size."""
    exclusion = F.col("exclusion_score")
    step = features.withColumns({
        "_blank": text_size(features) == 0,
        "score": linear_score(names, weights),
        "limit": F.when(exclusion > 1.0, F.lit(threshold) * (F.lit(1.0) + exclusion * 0.5)).otherwise(threshold),
        "feature_scores": component_scores(names, weights),
    })
    step = step.withColumn(
        "decision",
        F.when(F.col("_blank"), "ROUTING_ERROR")
        .when(exclusion > fv.HARD_EXCLUSION, "HARD_EXCLUSION")
        .when((exclusion > fv.SOFT_EXCLUSION) & (F.col("codes_count") == 0), "SOFT_EXCLUSION")
        .otherwise("SCORED"),
    )
    decision = F.col("decision")
    step = step.withColumn(
        "should_bid", (decision == "SCORED") & (F.col("score") >= F.col("limit"))
    )
    hard = F.concat(
        F.lit("HARD_EXCLUSION: Score "), fixed_decimals(exclusion, 1),
        F.lit(" - Strong non-IT indicators (construction/infrastructure/civil engineering). Automatically excluded."),
    )
    soft = F.concat(
        F.lit("SOFT_EXCLUSION: Score "), fixed_decimals(exclusion, 1),
        F.lit(" with no IT codes - Likely non-IT project without relevant codes."),
    )
    return step.withColumns({
        "ml_bid": F.when(~F.col("_blank"), F.col("should_bid")),
        "ml_confidence": F.when(decision == "SCORED", F.col("score"))
        .when(decision == "SOFT_EXCLUSION", 0.01).otherwise(0.0),
        "ml_reasoning": F.when(decision == "SCORED", reason_text(names, threshold))
        .when(decision == "HARD_EXCLUSION", hard).when(decision == "SOFT_EXCLUSION", soft),
        "ml_status": F.when(F.col("_blank"), "routing_error")
        .otherwise(F.when(F.col("should_bid"), "bid").otherwise("no-bid")),
    }).drop("_blank", "should_bid", "limit")


def route_by_length(
    text: Column | str, url: Column | str | None = None, limit: int = 100, strict: bool = False
) -> Column:
    """Next stage of a record: title-only without URL or with a short text, else scoring.

    ``strict`` sends records without URL to scoring too, which rejects them.
    """
    text = F.col(text) if isinstance(text, str) else text
    return route_by_size(F.octet_length(trim_all(text)), url, limit, strict)


def route_by_size(
    trimmed_bytes: Column | str, url: Column | str | None = None, limit: int = 100, strict: bool = False
) -> Column:
    """:func:`route_by_length` on rows that carry the size of their text in place of it."""
    size = F.col(trimmed_bytes) if isinstance(trimmed_bytes, str) else trimmed_bytes
    short = F.coalesce(size, F.lit(0)) < limit
    if url is not None:
        missing = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")) == ""
        short = (~missing & short) if strict else (missing | short)
    return F.when(short, "ai_summary_title_only").otherwise("ml_prediction")


def review_category(
    df: DataFrame, probability: str = "probability", threshold: float = fv.REVIEW_THRESHOLD, min_chars: int = 50
) -> DataFrame:
    """Review queue of each notice."""
    has_text = text_size(df) > min_chars
    p = F.when(has_text, F.col(probability))
    bid = F.coalesce(p >= threshold, F.lit(False))
    title = F.coalesce(F.col("title"), F.lit("Unknown"))
    percent = F.concat(fixed_decimals(p * 100.0, 1), F.lit("%"))
    pick = lambda none, yes, no: F.when(~has_text, none).when(bid, yes).otherwise(no)
    return df.withColumns({
        "category": pick("NO_PDF_DATA", "ML_PREDICTED_BID", "ML_PREDICTED_NO_BID"),
        "action": pick("MANUAL_REVIEW", "LLM_SUMMARY_REQUIRED", "LOW_PRIORITY_REVIEW"),
        "priority": pick("HIGH", "URGENT", "LOW"),
        "message": pick(
            F.concat(F.lit("⚠️ Manual Review Required: '"), title, F.lit("' - No PDF data available for ML analysis")),
            F.concat(F.lit("🎯 ACTION REQUIRED: '"), title, F.lit("' - ML predicts BID opportunity ("), percent, F.lit(" confidence)")),
            F.concat(F.lit("📋 Low Priority: '"), title, F.lit("' - ML suggests no bid ("), percent, F.lit(" confidence)")),
        ),
        "ml_probability": p,
        "requires_summary": has_text & bid,
    })


def signed_confidence(p: Column | str, threshold: float = fv.SIMPLE_THRESHOLD) -> Column:
    """Confidence in the predicted class, whichever it is."""
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p >= threshold, p).otherwise(1.0 - p)


def message_priority(should_bid: Column | str) -> Column:
    should_bid = F.col(should_bid) if isinstance(should_bid, str) else should_bid
    return F.when(should_bid, "URGENT").otherwise("NORMAL")


def summary_type(text: Column | str, limit: int = 100) -> Column:
    """Title-only for texts under ``limit`` bytes."""
    return summary_type_of(F.octet_length(F.col(text) if isinstance(text, str) else text), limit)


def summary_type_of(size: Column | str, limit: int = 100) -> Column:
    """:func:`summary_type` from the bytes of the text."""
    size = F.col(size) if isinstance(size, str) else size
    return F.when(F.coalesce(size, F.lit(0)) < limit, "TITLE_ONLY").otherwise("FULL_PDF")
