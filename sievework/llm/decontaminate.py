"""Benchmark passages in documents, found by template windows, in DataFrame expressions alone.

Texts become words without punctuation, in lower case. Numbers, units behind numbers, and names (words
with a capital inside a sentence) become typed placeholders, and their values are kept as slots. The
hash of each window of template words is joined with the windows of the benchmark. Windows that lie
alike in both texts form an alignment; its slots must fit: one value of the item always becomes the
same value of the document. So a question with other numbers or names is found, and windows that
merely share a form are not. Where a value does not fit, the windows over it do not count; windows
without it, or without any slot, still do.

Names are typed in a second form of a window, beside the one with the name's own letters: a text in
capitals only shows no names. A capital at the start of a sentence may be a name or not; a third form
takes it for one, and never makes a window of the other forms clash. Windows with too few plain words
for placeholders are compared with their own numbers and units, and items shorter than a window as a
whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import stored

WINDOW = 8                      # words, a power of two
LEAST_PLAIN = 4                 # words of a window that are no placeholders
BLOCK_WINDOWS = 200_000         # benchmark windows that are sent to all tasks at once; whole items make a block

START = "\ue002"                # marks the first word of a sentence
SENTENCE_END = "[.!?:]+[\"')]*[ \t\r\n]+[^\\p{L}\\p{N}]*"
NOISE = f"[^\\p{{L}}\\p{{N}}{START}]+"
# Units that stand behind a number.
UNITS = ("mm", "cm", "m", "km", "meter", "meters", "kilometers", "mile", "miles", "inch", "inches", "feet", "foot", "yards", "g", "kg", "mg", "gram", "grams",
         "kilograms", "lb", "lbs", "pound", "pounds", "ounces", "oz", "l", "ml", "liter", "liters", "gallon", "gallons", "s", "sec", "second", "seconds", "min",
         "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "degrees", "dollar",
         "dollars", "cents", "euro", "euros", "mph", "kmh", "kph", "v", "w", "kw", "hz", "khz", "mb", "gb")
NUMBER, UNIT, NAME, FIRST = "<num>", "<unit>", "<name>", "<first>"
VALUES, NAMES, GUESSES = (NUMBER, UNIT), (NUMBER, UNIT, NAME), (NUMBER, UNIT, NAME, FIRST)
CAPITALISED = f"^{START}?\\p{{Lu}}\\p{{Ll}}+$"


def digit(word: Column) -> Column:
    return F.ascii(word).between(48, 57)


def with_words(rows: DataFrame) -> DataFrame:
    """``words`` in lower case and, where a text has any, the placeholder of each (``kinds``)."""
    open_ = F.concat(F.lit(". "), F.replace(F.coalesce("text", F.lit("")), F.lit(START), F.lit(" ")))
    marked = F.rtrim(F.regexp_replace(open_, SENTENCE_END, " " + START), F.lit(" " + START))
    rows = rows.withColumn("marked", F.trim(F.regexp_replace(marked, NOISE, " "))).drop("text")
    lower = F.lower(F.replace("marked", F.lit(START), F.lit("")))
    rows = rows.withColumn("words", F.filter(F.split(lower, " "), lambda w: w != ""))
    cased = F.filter(F.split("marked", " "), lambda w: w != "")
    rows = rows.withColumn("cased", F.when(F.col("marked").rlike(f"[0-9]|[ {START}]\\p{{Lu}}\\p{{Ll}}+( |$)"), cased)).drop("marked")

    def kind(word: Column, at: Column) -> Column:
        behind = (at > 0) & digit(F.get("words", at - 1))
        own = F.get("cased", at)
        name = (own != word) & own.rlike(CAPITALISED)
        return F.when(digit(word), NUMBER).when(behind & word.isin(*UNITS), UNIT).when(name, F.when(own.startswith(START), FIRST).otherwise(NAME))

    return rows.withColumn("kinds", F.when(F.col("cased").isNotNull(), F.transform("words", kind))).drop("cased")


def hashed(rows: DataFrame, name: str, typed: tuple[str, ...], window: int) -> DataFrame:
    """``name``: the hash of every window, words of the ``typed`` kinds as placeholders.

    The forms with placeholders are null for a text without a word of their own kinds. Windows come from
    joining neighbouring windows, of half the size as long as that fits; the last ones, which would
    run over the end, are cut off.
    """
    mark = lambda k: F.when(k == FIRST, NAME).otherwise(k)
    template = F.zip_with("words", "kinds", lambda w, k: F.xxhash64(F.when(k.isin(*typed), mark(k)).otherwise(w)))
    own = typed[2:][-1:] or typed
    first = F.when(F.exists("kinds", lambda k: F.coalesce(k.isin(*own), F.lit(False))), template) if typed else F.transform("words", lambda w: F.xxhash64(w))
    rows = rows.withColumn("one", first).withColumn(name, F.col("one"))
    size = 1
    while size < window:
        step = size if 2 * size <= window else 1
        rows = rows.withColumn(name, F.zip_with(name, F.slice(name if step == size else "one", size + 1, F.greatest(F.size(name), F.lit(0))), lambda a, b: F.xxhash64(a, b)))
        size += step
    return rows.withColumn(name, F.slice(name, 1, F.greatest(F.size("words") - (window - 1), F.lit(0)))).drop("one")


FORMS = {"bare": (), "plain": VALUES, "named": NAMES, "guessed": GUESSES}


def hashed_windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each window and form that differs from the form before: ``hash``, place (``at``) and ``form``.

    Only bare numbers are spread, so what stays together with them, the words and the hashes of each form, is
    not copied unless a row goes on; :func:`cut_out` takes a window's share of it. ``n_words`` is that of the text.
    """
    keys = [c for c in rows.columns if c != "text"]
    rows = with_words(rows)
    for name, typed in FORMS.items():
        rows = hashed(rows, name, typed, window)
    nothing = F.array_repeat(F.lit(None).cast("bigint"), F.size("bare"))
    every = F.concat(*(F.coalesce(name, nothing) for name in FORMS))
    rows = rows.select(*keys, F.size("words").alias("n_words"), "words", "kinds", *FORMS, F.posexplode(every).alias("place", "hash"))
    rows = rows.where("hash is not null").withColumns({"form": (F.col("place") / F.size("bare")).cast("int"), "at": (F.col("place") % F.size("bare")).cast("int")})
    same = lambda *before: F.coalesce(F.get(F.coalesce(*before), "at") == F.col("hash"), F.lit(False))
    again = F.when(F.col("form") == 0, same("plain")).when(F.col("form") == 2, same("plain", "bare")).when(F.col("form") == 3, same("named", "plain", "bare"))
    return rows.where(~F.coalesce(again, F.lit(False))).drop("place")


def cut_out(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows with their own words and kinds in place of those of the whole text.

    All windows of a text that met an item leave the join before the next text is read, each as a row of its
    own. The cuts need no function of a lambda, so they belong to the code of the join, and none of these rows
    holds a copy of the text.
    """
    inside = {c: F.slice(c, F.col("at") + 1, F.lit(window)) for c in ("words", "kinds")}
    return rows.withColumns(inside | {"bare_hash": F.get("bare", "at"), "typed": F.col("plain").isNotNull()}).drop(*FORMS)


def described(rows: DataFrame) -> DataFrame:
    """The windows of :func:`cut_out` with the values under their placeholders (``slots``, null if none), whether
    they take the capital of a sentence for a name (``guess``), and whether they are a further form with the words
    in place of the placeholders (``literal``).
    """
    slots = lambda typed: F.zip_with("words", "kinds", lambda w, k: F.when(k.isin(*typed), w))
    form = F.col("form")
    literal = (form == 0) & F.col("typed")
    values = F.when(literal | ((form == 1) & (F.col("hash") != F.col("bare_hash"))), slots(VALUES)).when(form == 2, slots(NAMES)).when(form == 3, slots(GUESSES))
    rows = rows.withColumns({"slots": values, "guess": form == 3, "literal": literal})
    return rows.drop("words", "kinds", "form", "bare_hash", "typed")


def windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each window of the texts; see :func:`hashed_windows`, :func:`cut_out` and :func:`described`."""
    return described(cut_out(hashed_windows(rows, window), window))


def short_sizes(benchmark: DataFrame) -> list[int]:
    """Numbers of words of the items that are shorter than a window."""
    sizes = with_words(benchmark.select("text")).select(F.size("words").alias("n")).where(F.col("n").between(1, WINDOW - 1))
    return sorted(r.n for r in sizes.distinct().collect())


def item_windows(benchmark: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows of the items, each once; those with too few plain words for placeholders literally.

    Items of one of the ``sizes`` below WINDOW are one window each.
    """
    rows = benchmark.select("item_id", F.xxhash64("text").alias("item_row"), "text")
    found = windows(rows).withColumn("size", F.lit(WINDOW))
    for size in sizes:
        found = found.union(windows(rows, size).where(F.col("n_words") == size).withColumn("size", F.lit(size)))
    values = F.size(F.filter(F.coalesce("slots", F.array().cast("array<string>")), lambda s: s.isNotNull()))
    typed = (values == 0) | (F.col("size") - values >= LEAST_PLAIN)
    found = found.where(typed != F.col("literal"))
    slots = F.when(~F.col("literal"), F.col("slots")).alias("item_slots")
    return found.select("item_id", "item_row", "size", F.col("at").alias("item_at"), "hash", slots, F.col("guess").alias("item_guess")).distinct()


def distinct_pairs(met: Column) -> Column:
    """Pairs of an item's and a document's value under the windows of an alignment."""
    return F.array_distinct(F.flatten(F.transform(met, lambda w: w["pairs"])))


def clashing(pairs: Column) -> Column:
    """Values of the item that meet more than one value of the document."""
    values = F.transform(pairs, lambda p: p["item"])
    return F.filter(F.array_distinct(values), lambda v: F.size(F.filter(pairs, lambda p: p["item"] == v)) > 1)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value taken once, also where ``use`` needs it for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def fitting(met: Column, sure: Column) -> Column:
    """The number of an item's windows in an alignment, without those over a clashing value."""

    def count(clash: Column, guesses: Column) -> Column:
        fit = F.filter(met, lambda w: ~F.arrays_overlap(F.transform(w["pairs"], lambda p: p["item"]), F.when(w["guess"], guesses).otherwise(clash)))
        return F.size(F.array_distinct(F.transform(fit, lambda w: w["item_at"]))).cast("long")

    clashes = lambda windows, use: bound(distinct_pairs(windows), lambda pairs: bound(clashing(pairs), use))
    return clashes(sure, lambda clash: clashes(met, lambda guesses: count(clash, guesses)))


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, exact) for each document that holds a passage of an item.

    ``windows`` counts the item's windows in the best alignment, without those over a value that meets
    several values there; ``exact`` tells whether an alignment has the item's own values. An item of
    fewer than WINDOW words is one window; null and empty ones, or those without words, never match. Rows that repeat a
    document or an item count once; rows of one id with different texts are aligned each. A null id is
    an id of its own.
    """
    sizes = short_sizes(benchmark)
    items = stored(item_windows(benchmark, sizes), "item-windows")
    n_blocks = -(-items.count() // BLOCK_WINDOWS)
    rows = documents.select("doc_id", F.xxhash64("text").alias("doc_row"), "text")
    found = []
    for block in range(max(n_blocks, 1)):
        own = items.where(F.pmod(F.xxhash64("item_id", "item_row"), F.lit(max(n_blocks, 1))) == block)
        for size in (WINDOW, *sizes):
            met = hashed_windows(rows, size).join(F.broadcast(own.where(F.col("size") == size).drop("size")), "hash")
            found.append(described(cut_out(met, size)))
    met = reduce(DataFrame.unionByName, found)
    values = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    pairs = F.filter(F.coalesce(values, F.array().cast("array<struct<item:string,doc:string>>")), lambda p: p["item"].isNotNull())
    met = met.select("doc_id", "doc_row", "item_id", "item_row", (F.col("at") - F.col("item_at")).alias("shift"), F.struct("item_at", pairs.alias("pairs"), (F.col("guess") | F.col("item_guess")).alias("guess")).alias("w"))
    aligned = met.groupBy("doc_id", "doc_row", "item_id", "item_row", "shift").agg(F.collect_set("w").alias("met"))
    sure = F.filter("met", lambda w: ~w["guess"])
    exact = (F.size(sure) > 0) & F.forall(distinct_pairs(sure), lambda p: p["item"] == p["doc"])
    aligned = aligned.select("doc_id", "item_id", fitting(F.col("met"), sure).alias("n"), exact.alias("own"))
    found = aligned.groupBy("doc_id", "item_id").agg(F.max("n").alias("windows"), F.coalesce(F.max(F.when(F.col("n") > 0, F.col("own"))), F.lit(False)).alias("exact"))
    return found.where("windows > 0")
