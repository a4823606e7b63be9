"""Text measures and section extraction as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.clean import _c, is_blank, trim_all

# Word characters and white space by their Unicode properties. Java tests these classes with one
# look-up per character; a spelled-out list of characters is ten times slower.
WORDS = r"(?U)\w+"
NON_SPACE = r"(?U)\S+"

# Section "5 Lot ..." up to a line that starts section 6, and its fallback of 5.x blocks.
SECTION_FIVE = r"(?ims)(?:^|\n)\s*5\s+lot.*?(?=(?:^|\n)\s*6\s+|\z)"
SECTION_FIVE_PARTS = r"(?ims)(?:^|\n)\s*5\.\d+.*?(?=(?:^|\n)\s*6\.\d+|\z)"


def word_count(c: Column | str) -> Column:
    """Runs of non-white-space, 0 for NULL."""
    return F.regexp_count(F.coalesce(_c(c), F.lit("")), F.lit(NON_SPACE))


def combined_text(title: Column | str, text: Column | str) -> Column:
    none = F.lit("")
    return F.lower(F.concat(F.coalesce(_c(title), none), F.lit(" "), F.coalesce(_c(text), none)))


def word_tokens(c: Column | str) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(_c(c), F.lit(WORDS), F.lit(0))


def phrase_count(text: Column, phrase: str, whole_words: bool) -> Column:
    """Non-overlapping occurrences of a literal phrase in lower-cased text."""
    if whole_words:
        quoted = f"(?U)(?<!\\w)\\Q{phrase}\\E(?!\\w)"
        return F.regexp_count(text, F.lit(quoted))
    dropped = F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))
    return (dropped / F.lit(len(phrase))).cast("int")


def extract_section(c: Column | str) -> Column:
    """The "5 Lot" section, else all 5.x blocks on lines of their own, else ""."""
    text = F.coalesce(_c(c), F.lit(""))
    # A scan for the digit 5 followed by "lot" is far cheaper than the lazy match, which is
    # therefore only tried on texts that can match at all.
    lot = F.when(text.rlike(r"(?i)5\s+lot"), F.regexp_extract(text, SECTION_FIVE, 0)).otherwise("")
    parts = F.when(
        text.rlike(r"5\.\d"), F.regexp_extract_all(text, F.lit(SECTION_FIVE_PARTS), F.lit(0))
    ).otherwise(F.array().cast("array<string>"))
    joined = F.array_join(F.transform(parts, trim_all), "\n")
    return F.when(lot != "", trim_all(lot)).otherwise(joined)


def text_measures(docs: DataFrame) -> DataFrame:
    """Length and word count of each text, and its trimmed length, without the text.

    Joined to the notices in place of the texts, these give the same features from a narrow row.
    """
    return docs.withColumns({
        "pdf_text_length": F.length(F.coalesce("pdf_text", F.lit(""))),
        "pdf_text_word_count": word_count("pdf_text"),
        "text_chars": F.length(trim_all(F.coalesce("pdf_text", F.lit("")))),
    }).drop("pdf_text")


def text_sizes(docs: DataFrame) -> DataFrame:
    """Key, bytes, characters, and trimmed bytes and characters of each text, without the text."""
    text, trimmed = F.coalesce("pdf_text", F.lit("")), trim_all(F.coalesce("pdf_text", F.lit("")))
    return docs.select(
        "resource_id", F.octet_length(text).alias("text_bytes"), F.length(text).alias("pdf_text_length"),
        F.octet_length(trimmed).alias("trimmed_bytes"), F.length(trimmed).alias("text_chars"),
    )


def text_features(df: DataFrame) -> DataFrame:
    """Lengths, word counts, their ratio and the code density.

    Rows joined to :func:`text_measures` need no text; a notice without one has length 0.
    """
    zero = F.lit(0)
    if "text_chars" in df.columns:
        text = {c: F.coalesce(c, zero) for c in ("pdf_text_length", "pdf_text_word_count", "text_chars")}
    else:
        text = {
            "pdf_text_length": F.length("pdf_text"),
            "pdf_text_word_count": F.when(F.col("pdf_text").isNotNull(), word_count("pdf_text")),
        }
    measured = df.withColumns({
        "title_length": F.length("title"),
        "title_word_count": F.when(F.col("title").isNotNull(), word_count("title")),
        "codes_count": F.coalesce("codes_count", zero),
    } | text)
    return measured.withColumns({
        "pdf_to_title_ratio": F.col("pdf_text_length").cast("double") / (F.col("title_length") + 1),
        "code_density": F.col("codes_count").cast("double") / (F.col("pdf_text_length") / F.lit(1000.0) + 1),
    })


def presence_flags(df: DataFrame) -> DataFrame:
    """0/1 flags for a document URL, a text and detected codes."""
    has_text = F.coalesce("text_chars", F.lit(0)) > 0 if "text_chars" in df.columns else ~is_blank("pdf_text")
    return df.withColumns({
        "has_pdf": F.when(is_blank("pdf_url"), 0).otherwise(1),
        "has_pdf_content": has_text.cast("int"),
        "has_codes": F.when(F.col("codes_count") > 0, 1).otherwise(0),
    })


def truncate_bytes(c: Column | str, limit: int, mark: str = "") -> Column:
    """Cut text at ``limit`` UTF-8 bytes, never inside a character, and add ``...`` (and ``mark``).

    The byte prefix is cut on the encoded form; a half character at its end decodes to U+FFFD
    marks, which are dropped by counting the continuation bytes that the cut left behind.
    """
    c = _c(c)
    raw = F.encode(c, "UTF-8")
    # Step back over at most three continuation bytes (10xxxxxx) that follow the cut.
    step = F.lit(0)
    for back in (3, 2, 1, 0):
        following = F.conv(F.hex(F.substring(raw, limit + 1 - back, 1)), 16, 10).cast("int")
        starts_character = ~following.between(128, 191)
        step = F.when(starts_character, F.lit(back)).otherwise(step)
    kept = F.decode(F.substr(raw, F.lit(1), F.lit(limit) - step), "UTF-8")
    return F.when(F.octet_length(c) > limit, F.concat(kept, F.lit("..." + mark))).otherwise(c)
