"""Cleaning of scraped text fields: tags, dates, money, URLs, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property. Spark's own trim takes
# spaces only; the stored texts are trimmed of all of them.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
DATE_TIME = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"
DATE_FORMS = (  # pattern, and its groups as year-month-day
    (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"),
    (r"^\s*(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"),
    (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3"),
)
MONEY = r"[€£$]?[0-9,]+\.?[0-9]*"
STORED_DATE = r"^[A-Za-z]{3} ([A-Za-z]{3}) (\d{1,2}) (\d{2}:\d{2}:\d{2}) [A-Z]{3} (\d{4})$"
STORED_MONEY = r"^[€£]?[0-9,]+\.?[0-9]*$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: Column | str) -> Column:
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.length(trim_all(F.coalesce(_c(c), F.lit("")))) == 0


def strip_html(c: Column | str) -> Column:
    """Drop everything between ``<`` and ``>``; an unclosed ``<`` drops the tail, a stray ``>`` goes too."""
    return trim_all(F.replace(F.regexp_replace(_c(c), "<[^>]*(>|$)", ""), F.lit(">"), F.lit("")))


def _reordered(c: Column, pattern: str, groups: str, kind: str) -> Column:
    """Text that matches the pattern, its groups put in order and cast; NULL otherwise."""
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, groups).try_cast(kind))


def parse_datetime(c: Column | str) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` to a zone-free timestamp; empty or bad text gives NULL.

    Built from the matched digits and a cast, so the session time zone plays no part.
    """
    return _reordered(_c(c), DATE_TIME, "$3-$2-$1 $4:$5:$6", "timestamp_ntz")


def parse_date(c: Column | str) -> Column:
    """The date of a date-time, or one of three plain date forms; else NULL."""
    c = _c(c)
    plain = [_reordered(c, pattern, groups, "date") for pattern, groups in DATE_FORMS]
    return F.coalesce(parse_datetime(c).cast("date"), *plain)


def parse_money(c: Column | str) -> Column:
    """First amount in the text without symbol and thousands commas; NULL when there is none."""
    found = F.regexp_extract(_c(c), MONEY, 0)
    return F.translate(found, "€£$,", "").try_cast("decimal(38,10)")


def build_url(key: Column | str, base: str, shown: Column | None = None) -> Column:
    """``base`` + key, or "" without a key (and, in the second layout, without a document cell)."""
    key = _c(key)
    present = F.coalesce(key, F.lit("")) != ""
    if shown is not None:
        present = present & (F.coalesce(shown, F.lit("")) != "")
    return F.when(present, F.concat(F.lit(base), key)).otherwise("")


def type_records(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw notices (all text) to typed ones: a bad key becomes 0, bad dates and amounts NULL.

    ``keep`` names further columns that pass as they are.
    """
    return raw.select(
        F.coalesce(F.col("resource_id").try_cast("bigint"), F.lit(0).cast("bigint")).alias("resource_id"),
        "title", "ca", "info",
        parse_datetime("published").alias("published"),
        parse_datetime("deadline").alias("deadline"),
        "procedure", "status", "pdf_url",
        parse_date("awarddate").alias("awarddate"),
        parse_money("value").try_cast("decimal(15,2)").alias("value"),
        "cycle",
        F.lit(None).cast("int").alias("bid"),
        *keep,
    )


def utc_time(c: Column | str) -> Column:
    """An ISO time with its offset (none: UTC) as a zone-free time in UTC, fraction included; else NULL.

    The session's time zone plays no part.
    """
    c = _c(c)
    zoned = F.when(c.rlike(r"(?:[Zz]|[+-]\d\d:?\d\d)$"), c).otherwise(F.concat(c, F.lit("Z")))
    micros = F.unix_micros(F.replace(zoned, F.lit(" "), F.lit("T")).try_cast("timestamp"))
    days = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    rest = (micros - days.cast("bigint") * 86_400_000_000).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(18,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))


def migrate_timestamp(c: Column | str) -> Column:
    """Text of the form ``Fri Jun 13 12:54:34 IST 2025`` to a zone-free timestamp; other text to NULL."""
    c = _c(c)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(c, 5, 3))).cast("string")
    text = F.concat_ws("-", F.regexp_replace(c, STORED_DATE, "$4"), month, F.regexp_replace(c, STORED_DATE, "$2 $3"))
    return F.when(c.rlike(STORED_DATE), text.try_cast("timestamp_ntz"))


def migrate_date(c: Column | str) -> Column:
    return migrate_timestamp(c).cast("date")


def migrate_money(c: Column | str) -> Column:
    """Whole text must be one €, £ or plain amount; else NULL."""
    c = _c(c)
    return F.when(c.rlike(STORED_MONEY), F.translate(c, "€£,", "").try_cast("decimal(15,2)"))


def migrate_label(c: Column | str) -> Column:
    return _c(c).cast("int")


def rollback_timestamp(c: Column | str) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def rollback_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Typed columns back to text."""
    kinds = dict(df.dtypes)
    return df.select(*[
        (rollback_timestamp(c) if kinds[c].startswith("timestamp") else F.col(c).cast("string")).alias(c)
        if c in columns else F.col(c)
        for c in df.columns
    ])


def presence_flag(c: Column | str) -> Column:
    """1 when the text holds more than white space, else 0."""
    return F.when(is_blank(c), 0).otherwise(1)


def contains_year(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit("")).rlike(r"\b20\d{2}\b").cast("int")


def min_value(c: Column | str, bound: float) -> Column:
    """Text amount at least ``bound``: every character but digits and the dot is dropped first."""
    c = _c(c)
    amount = F.regexp_replace(c, "[^0-9.]", "").try_cast("decimal(38,10)")
    return c.isNotNull() & (c != "") & (amount >= F.lit(bound))
