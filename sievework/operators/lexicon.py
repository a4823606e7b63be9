"""Word-list scoring and dictionary look-ups over texts, one pass per text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.functions.text import phrase_count, word_count, word_tokens
from sievework.session import cut_lineage


@dataclass(frozen=True)
class Lexicon:
    """The word lists behind the text features. All words are lower case."""

    key_terms: Mapping[str, float] = field(default_factory=lambda: dict(fv.KEY_TERMS))
    terms: tuple[str, ...] = fv.EXCLUSION_TERMS
    heavy_terms: tuple[str, ...] = fv.HEAVY_EXCLUSION_TERMS
    phrases: tuple[str, ...] = fv.EXCLUSION_PHRASES
    term_weight: float = 1.0
    heavy_weight: float = 2.0
    phrase_weight: float = 1.5
    per_words: float = 50.0
    cap: float = 15.0

    def whole_word_weights(self) -> dict[str, float]:
        """Weight per whole-word entry; an entry on both lists counts for both."""
        weights: dict[str, float] = defaultdict(float)
        for words, weight in ((self.terms, self.term_weight), (self.heavy_terms, self.heavy_weight)):
            for word in words:
                weights[word] += weight
        return dict(weights)


def _is_word(term: str) -> bool:
    return re.fullmatch(r"\w+", term) is not None


def _total(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def lexicon_hits(text: Column, words: Iterable[str]) -> Column:
    """The words of ``text`` that are on the list, with repeats: one split and a hash-set test."""
    listed = sorted(set(words))
    return F.filter(word_tokens(text), lambda t: t.isin(*listed))


def _among(hits: Column, words: Iterable[str]) -> Column:
    """How many of the hits are one of ``words``."""
    listed = sorted(set(words))
    return F.size(F.filter(hits, lambda t: t.isin(*listed)))


def _hit_points(hits: Column, weights: Mapping[str, float]) -> Column:
    """Sum of weights over the hits, with one hash-set test per distinct weight."""
    by_weight: dict[float, list[str]] = defaultdict(list)
    for word, weight in weights.items():
        by_weight[weight].append(word)
    return _total(
        _among(hits, words) * F.lit(weight)
        for weight, words in sorted(by_weight.items())
    )


def _phrase_points(text: Column, whole: Mapping[str, float], loose: Mapping[str, float]) -> Column:
    """Points of multi-word entries.

    Entries that share their last word sit behind one substring test for it, so a text without
    the word "works" pays one scan for all phrases that end with it.
    """
    groups: dict[str, list[Column]] = defaultdict(list)
    for entries, as_words in ((whole, True), (loose, False)):
        for phrase, weight in entries.items():
            groups[phrase.split()[-1]].append(phrase_count(text, phrase, as_words) * F.lit(weight))
    return _total(
        F.when(text.contains(last), _total(points)).otherwise(0.0) for last, points in sorted(groups.items())
    )


def _short_phrase_points(text: Column, whole: Mapping[str, float], loose: Mapping[str, float]) -> Column:
    """The same for titles and seams: one small expression over the list of entries."""
    entries = [(p, w, True) for p, w in whole.items()] + [(p, w, False) for p, w in loose.items()]
    if not entries:
        return F.lit(0.0)
    listed = F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit(float(w)).alias("w"), F.lit(b).alias("b")) for p, w, b in entries
    ])
    found = F.filter(listed, lambda e: text.contains(e["p"]))

    def points(total: Column, e: Column) -> Column:
        as_words = F.regexp_count(text, F.concat(F.lit(r"(?U)(?<!\w)\Q"), e["p"], F.lit(r"\E(?!\w)")))
        anywhere = (F.length(text) - F.length(F.replace(text, e["p"], F.lit("")))) / F.length(e["p"])
        return total + e["w"] * F.when(e["b"], as_words.cast("double")).otherwise(F.floor(anywhere).cast("double"))

    return F.aggregate(found, F.lit(0.0), points)


def _split_entries(lex: Lexicon) -> tuple[dict[str, float], dict[str, float], dict[str, float]]:
    weights = lex.whole_word_weights()
    words = {w: x for w, x in weights.items() if _is_word(w)}
    whole = {w: x for w, x in weights.items() if not _is_word(w)}
    return words, whole, {p: lex.phrase_weight for p in lex.phrases}


def _doubled(entry: str, as_words: bool) -> list[str]:
    """Texts in which two occurrences of an entry overlap, such as "school mealschool meals".

    A whole-word entry can only share whole words with its repeat.
    """
    out = []
    for shared in range(1, len(entry)):
        if not entry.startswith(entry[-shared:]):
            continue
        if as_words and (_is_word(entry[shared]) or _is_word(entry[-shared - 1])):
            continue
        out.append(entry + entry[shared:])
    return out


def _head(low: Column, lex: Lexicon) -> Column:
    """The start of a text that decides which entries run into it from the text before.

    An entry that crosses the seam ends within one entry length. It may take the place of one that
    overlaps it, which ends within two. Only where that one overlaps a further one would counts
    beyond be shifted; such a text, if there ever is one, is carried whole.
    """
    _, whole, loose = _split_entries(lex)
    entries = [*((e, True) for e in (*whole, *(t for t in lex.key_terms if not _is_word(t)))), *((e, False) for e in loose)]
    longest = max([len(e) for e, _ in entries], default=1)
    doubles = [d for e, as_words in entries for d in _doubled(e, as_words)]
    start = F.left(low, F.lit(3 * longest))
    short = F.left(low, F.lit(2 * longest))
    if not doubles:
        return short
    return F.when(F.exists(F.array(*[F.lit(d) for d in doubles]), lambda d: start.contains(d)), low).otherwise(short)


def lexicon_counts(
    df: DataFrame, text: Column | str, lexicon: Lexicon | None = None, prefix: str = "d_", short: bool = False
) -> DataFrame:
    """Add the additive counts of one text column, a few numbers per row:

    ``<prefix>words``, ``<prefix>points`` (weighted list entries), ``<prefix>n_<term>`` per key
    term, and ``<prefix>head``, its start, for entries that run into it from the text before.

    The counts of two texts add up to those of the joined text (:func:`lexicon_features`), so
    long texts are counted where they lie and not shuffled to the notice they belong to. Short
    texts are counted by a smaller plan and have no head.
    """
    lex = lexicon or Lexicon()
    words, whole, loose = _split_entries(lex)
    key_words = [t for t in lex.key_terms if _is_word(t)]
    source = F.col(text) if isinstance(text, str) else text

    # Each step is a projection of its own: the text is lowered and cut into words once per row,
    # and the many small counts read the short array of hits.
    low = F.col("_low")
    step = df.withColumn("_low", F.lower(F.coalesce(source, F.lit(""))))
    step = step.withColumns({
        f"{prefix}words": word_count(low),
        "_hits": lexicon_hits(low, [*words, *key_words]),
        "_phrases": (_short_phrase_points if short else _phrase_points)(low, whole, loose),
    } | ({} if short else {f"{prefix}head": _head(low, lex)}) | {
        f"{prefix}n_{t}": phrase_count(low, t, True) for t in lex.key_terms if t not in key_words
    })
    hits = F.col("_hits")
    return step.withColumns({
        f"{prefix}points": _hit_points(hits, words) + F.col("_phrases"),
    } | {f"{prefix}n_{t}": _among(hits, [t]) for t in key_words}).drop("_low", "_hits", "_phrases")


def _counter(term: str):
    return lambda text: phrase_count(text, term, True)


def lexicon_features(
    df: DataFrame, lexicon: Lexicon | None = None, title: str = "title", text: str = "pdf_text"
) -> DataFrame:
    """Add ``n_words``, ``exclusion_score`` and per key term ``count_<t>`` and ``tfidf_<t>``.

    The features are those of title, a space, and text. Rows that already carry the counts of the
    text (``d_...``, NULL for a notice without one) need not carry the text itself.
    """
    lex = lexicon or Lexicon()
    _, whole, loose = _split_entries(lex)
    counted = df if "d_words" in df.columns else lexicon_counts(df, text, lex, "d_")
    counted = lexicon_counts(counted, title, lex, "t_", short=True)
    zero, none = F.lit(0), F.lit("")
    # Entries across the seam: those of title and text start together that neither holds alone.
    ends = (F.col("_title"), F.coalesce(F.col("d_head"), none))
    counted = counted.withColumn("_title", F.lower(F.coalesce(F.col(title), none)))
    counted = counted.withColumn("_seam", F.concat(ends[0], F.lit(" "), ends[1]))
    seam = F.col("_seam")

    def across(count) -> Column:
        return count(seam) - count(ends[0]) - count(ends[1])

    both = lambda name: F.col(f"t_{name}") + F.coalesce(F.col(f"d_{name}"), zero)
    crossing = across(lambda c: _short_phrase_points(c, whole, loose))
    step = counted.withColumns({
        "n_words": both("words"), "_points": both("points") + crossing,
    } | {
        f"count_{t}": both(f"n_{t}") if _is_word(t) else both(f"n_{t}") + across(_counter(t))
        for t in lex.key_terms
    })
    words = F.col("n_words").cast("double")

    def per_word(count: Column, factor: float, cap: float) -> Column:
        return F.when(words > 0, F.least(count / words * F.lit(factor), F.lit(cap))).otherwise(0.0)

    step = step.withColumns({
        "exclusion_score": per_word(F.col("_points"), lex.per_words, lex.cap),
    } | {
        f"tfidf_{t}": per_word(F.col(f"count_{t}"), weight, 1.0) for t, weight in lex.key_terms.items()
    })
    names = [f"{p}{n}" for p in ("t_", "d_") for n in ("words", "points", "head", *(f"n_{t}" for t in lex.key_terms))]
    return step.drop("_seam", "_title", "_points", *names)


def encode_authority(c: Column | str, codes: Mapping[str, int] | None = None) -> Column:
    """Authority name to code: exact, else either name contains the other (lowest code wins),
    else a hash code from 11 to 100."""
    codes = dict(fv.AUTHORITY_CODES if codes is None else codes)
    name = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    # One list of (name, code), searched once per row; its length is not part of the plan's depth.
    known = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(v).alias("code")) for k, v in codes.items()])
    lowest = lambda found: F.array_min(F.transform(found, lambda x: x["code"]))
    exact = lowest(F.filter(known, lambda x: x["name"] == name))
    partial = lowest(F.filter(known, lambda x: name.contains(x["name"]) | x["name"].contains(name)))
    # 32 bits of the digest; any fixed hash will do, this one is the same in every SQL engine.
    hashed = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") % 90 + 11
    return F.coalesce(exact, partial, hashed.cast("int")).cast("double")


def vocabulary_counts(df: DataFrame, text: Column, vocabulary: Sequence[str], prefix: str) -> DataFrame:
    """Add ``<prefix><term>``: how often each listed word occurs in the text."""
    words = [t.lower() for t in vocabulary]
    hits = df.withColumn("_hits", lexicon_hits(F.lower(F.coalesce(text, F.lit(""))), words))
    return hits.withColumns({f"{prefix}{t}": _among(F.col("_hits"), [t]) for t in words}).drop("_hits")


def tfidf_from_counts(df: DataFrame, vocabulary: Sequence[str], counts: str = "n_", prefix: str = "tfidf_") -> DataFrame:
    """Counts ``n_<term>`` to TF-IDF: smooth idf plus one, rows scaled to unit length.

    The narrow counts are written once, because they are read twice: for the document
    frequencies, one row, and for the weights.
    """
    rows = cut_lineage(df)
    n = {t: F.col(f"{counts}{t}") for t in vocabulary}
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(n[t] > 0).alias(f"df_{t}") for t in vocabulary]
    ).select(F.struct("*").alias("s")).scalar()
    idf = {t: F.log((F.col("_s.n") + 1.0) / (F.col(f"_s.df_{t}") + 1.0)) + 1.0 for t in vocabulary}
    raw = rows.withColumn("_s", stats).withColumns({f"{prefix}{t}": n[t] * idf[t] for t in vocabulary})
    squares = _total(F.col(f"{prefix}{t}") * F.col(f"{prefix}{t}") for t in vocabulary)
    length = F.nullif(F.sqrt(squares), F.lit(0.0))
    return raw.withColumn("_length", length).withColumns({
        f"{prefix}{t}": F.coalesce(F.col(f"{prefix}{t}") / F.col("_length"), F.lit(0.0)) for t in vocabulary
    }).drop("_s", "_length", *[f"{counts}{t}" for t in vocabulary])


def fixed_vocabulary_tfidf(
    df: DataFrame, keep: Sequence[str], text: Column, vocabulary: Sequence[str], prefix: str = "tfidf_"
) -> DataFrame:
    """The ``keep`` columns and the TF-IDF of a text column on a fixed word list."""
    counted = vocabulary_counts(df, text, vocabulary, "n_")
    return tfidf_from_counts(counted.select(*keep, *[f"n_{t}" for t in vocabulary]), vocabulary, "n_", prefix)
