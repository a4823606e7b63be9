"""Splits, encoders and term tables that feed the models; all of them plain DataFrame work."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions.text import word_tokens
from sievework.operators.lexicon import tfidf_from_counts, vocabulary_counts
from sievework.session import cut_lineage

BLOCK_WORDS = 1 << 20           # words that a task counts at once, or one text

# -- repeatable splits ----------------------------------------------------------------------------

def rank_cuts(df: DataFrame, key: str, label: str, ranks, seed: int = 42, bits: int = 16, most: int = 1 << 20) -> DataFrame:
    """(label, cuts): where each class has its wanted ranks, as structs (h, key) in seeded hash order.

    ``ranks`` makes columns of ranks from 0 out of the size of a class. A histogram over the first ``bits`` of the
    hash tells which cell holds a rank; cells of more than ``most`` rows are split by the next bits, and
    the others sorted. Only keys and labels are read, and one row a class, cell and rank is kept. A rank
    beyond the class has no cut. The order is total (hash, then key), so it never depends on the run.
    """
    spark = df.sparkSession
    rows = df.select(F.col(label).alias("label"), F.col(key).alias("key"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def placed(counted: DataFrame, within: list[str], order: list[str]) -> DataFrame:
        """The rows of ``counted`` that hold wanted ranks, and these ranks within them."""
        before = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = F.filter("wanted", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
        return counted.withColumn("wanted", F.transform(inside, lambda r: r - F.col("start"))).where(F.size("wanted") > 0)

    cell = lambda used: F.shiftright("h", 64 - used)
    first = cut_lineage(rows.groupBy("label", cell(bits).alias("cell")).agg(F.count(F.lit(1)).alias("n")))
    size = F.sum("n").over(Window.partitionBy("label"))
    cells = placed(first.withColumn("size", size).withColumn("wanted", F.array(*(r.cast("long") for r in ranks(F.col("size"))))), ["label"], ["cell"])
    used = bits
    while True:
        held = cells.select("label", "cell", "wanted", "n").collect()        # a class has as many as it has ranks
        cells = spark.createDataFrame(held, f"label {kinds['label']}, cell long, wanted array<long>, n long").drop("n")
        here = rows.withColumn("cell", cell(used)).join(
            F.broadcast(cells.withColumnsRenamed({"label": "_label", "cell": "_cell"})), F.col("label").eqNullSafe(F.col("_label")) & (F.col("cell") == F.col("_cell")))
        here = here.drop("_label", "_cell")
        if used + bits > 64 or max((r.n for r in held), default=0) <= most:
            break
        used += bits
        counted = here.groupBy("label", "cell", "wanted", cell(used).alias("finer")).agg(F.count(F.lit(1)).alias("n"))
        cells = placed(counted, ["label", "cell"], ["finer"]).drop("cell").withColumnRenamed("finer", "cell")
    counted = here.groupBy("label", "cell", "wanted", "h", "key").agg(F.count(F.lit(1)).alias("n"))
    exact = placed(counted, ["label", "cell"], ["h", "key"])
    # A row stands for as many cuts as it holds ranks.
    cut = F.explode(F.transform("wanted", lambda _: F.struct("h", "key"))).alias("cut")
    found = exact.select("label", cut).groupBy("label").agg(F.array_sort(F.collect_list("cut")).alias("cuts")).collect()
    return spark.createDataFrame(found, f"label {kinds['label']}, cuts array<struct<h:bigint,key:{kinds['key']}>>")


def below_cuts(df: DataFrame, key: str, label: str, cuts: DataFrame, seed: int) -> DataFrame:
    """``df`` plus ``_below``: how many cuts of its class a row has reached, by comparison where it is read."""
    own = cuts.withColumnsRenamed({"label": "_label", "cuts": "_cuts"})      # made of what the driver held, one row a class
    joined = df.join(F.broadcast(own), F.col(label).eqNullSafe(F.col("_label")), "left")
    here = F.struct(F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(key).alias("key"))
    return joined.withColumn("_below", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= here)), F.lit(0))).drop("_label", "_cuts")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` plus ``fold`` 0..k-1; the sizes of a class in the folds differ by at most one.

    Rows that repeat a key and label stay together, so a fold may then be larger by as many. Null labels are a class.
    """
    cuts = rank_cuts(df, key, label, lambda n: [F.ceil(n * j / k) for j in range(1, k)], seed)
    return below_cuts(df, key, label, cuts, seed).withColumnRenamed("_below", "fold")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` plus ``is_test``: the given share of every class; rows that repeat a key stay together."""
    cuts = rank_cuts(df, key, label, lambda n: [F.round(n * test_size)], seed)
    return below_cuts(df, key, label, cuts, seed).withColumn("is_test", F.col("_below") == 0).drop("_below")


# -- encoders -------------------------------------------------------------------------------------

def class_weights(df: DataFrame, label: str = "bid") -> DataFrame:
    """``df`` plus ``weight`` n / (2 n_class), so that both classes weigh the same."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")
    ).select(F.struct("p", "q").alias("c")).scalar()
    own = F.when(F.col(label) == 1, F.col("_c.p")).otherwise(F.col("_c.q"))
    weight = (F.col("_c.p") + F.col("_c.q")) / F.nullif(2.0 * own, F.lit(0.0))
    return df.withColumn("_c", counts).withColumn("weight", weight).drop("_c")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct values numbered from 0 in alphabetical order.

    The values are cut into ranges, written with the number of their range, and numbered within it on
    top of the ranges below, one row each.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct()
    ranged = cut_lineage(values.repartitionByRange("value").withColumn("_range", F.spark_partition_id()))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("value")) - 1
    numbered = ranged.withColumn("_place", place).join(starts, "_range")
    return numbered.select("value", (F.col("_start") + F.col("_place")).cast("int").alias("code"))


def label_encode(df: DataFrame, column: str, codes: DataFrame, unseen: int = 0, output: str | None = None) -> DataFrame:
    """Alphabetical label codes; an unseen value gets ``unseen``."""
    named = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(named, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(output or f"{column}_encoded", F.coalesce("_code", F.lit(unseen))).drop("_value", "_code")


def rare_to_null(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """Values seen fewer than ``min_count`` times become NULL."""
    common = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
    kept = common.select(F.col(column).alias("_common"))
    joined = df.join(kept, F.col(column) == F.col("_common"), "left")
    return joined.withColumn(column, F.col("_common")).drop("_common").select(*df.columns)


def scale_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = df.agg(*[
        e.alias(f"{n}_{c}") for c in columns for n, e in (("m", F.avg(c)), ("s", F.stddev_pop(c)))
    ]).select(F.struct("*").alias("s")).scalar()
    scaled = {
        c: (F.col(c) - F.col(f"_s.m_{c}")) / F.when(F.col(f"_s.s_{c}") == 0, 1.0).otherwise(F.col(f"_s.s_{c}"))
        for c in columns
    }
    return df.withColumn("_s", stats).withColumns(scaled).drop("_s")


def code_onehot(df: DataFrame, codes: Sequence[str] | None = None, name=lambda code: f"code_{code}") -> DataFrame:
    """One 0/1 column per code, sorted (M01); without ``codes``, per code that occurs.

    The columns are part of the plan. For a dictionary too wide for that take :func:`code_bits` or the
    sparse vectors of the feature stages.
    """
    if codes is None:
        codes = [r["code"] for r in df.select(F.explode("detected_codes").alias("code")).distinct().collect()]
    return df.withColumns({
        name(c): F.coalesce(F.array_contains("detected_codes", c), F.lit(False)).cast("int") for c in sorted(codes)
    })


def code_bits(df: DataFrame, output: str = "bits") -> DataFrame:
    """The 0/1 marks of all codes that occur, in order, as one array column."""
    every = df.select(F.explode("detected_codes").alias("code")).agg(F.array_sort(F.collect_set("code")).alias("codes")).scalar()
    marks = F.transform("_codes", lambda c: F.coalesce(F.array_contains("detected_codes", c), F.lit(False)).cast("int"))
    return df.withColumn("_codes", every).withColumn(output, marks).drop("_codes")


def document_terms(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Key, codes, text length and word-list counts of each document, without its text."""
    counted = vocabulary_counts(docs, F.col("pdf_text"), vocabulary, "d_n_")
    return counted.select(
        "resource_id", "codes_count", F.length(F.coalesce("pdf_text", F.lit(""))).alias("text_length"),
        *[f"d_n_{t}" for t in vocabulary],
    )


def feature_matrix(
    notices: DataFrame, docs: DataFrame, vocabulary: Sequence[str], ca_codes: DataFrame, unseen: int = 0,
    with_text_length: bool = False,
) -> DataFrame:
    """Key and the 14 features of the trained predictor, 15 with the text length.

    Title and text are counted where they are read; words do not run across the space between
    them, so their counts add up.
    """
    joined = notices.join(document_terms(docs, vocabulary), "resource_id", "left")
    named = joined.withColumn("_ca", F.coalesce(F.col("ca"), F.lit("Unknown")))
    encoded = label_encode(named, "_ca", ca_codes, unseen, "ca_encoded")
    counted = vocabulary_counts(encoded, F.col("title"), vocabulary, "t_n_")
    zero = F.lit(0)
    count = F.coalesce(F.col("codes_count"), zero).cast("double")
    extra = [F.coalesce("text_length", zero).cast("double").alias("text_length")] if with_text_length else []
    label = ["bid"] if "bid" in notices.columns else []
    rows = counted.select(
        "resource_id", *label, count.alias("codes_count"), F.when(count > 0, 1.0).otherwise(0.0).alias("has_codes"),
        F.length(F.coalesce("title", F.lit(""))).cast("double").alias("title_length"), *extra,
        F.col("ca_encoded").cast("double").alias("ca_encoded"),
        *[(F.col(f"t_n_{t}") + F.coalesce(F.col(f"d_n_{t}"), zero)).alias(f"n_{t}") for t in vocabulary],
    )
    return tfidf_from_counts(rows, vocabulary)


# -- terms ----------------------------------------------------------------------------------------

def accents() -> tuple[str, str]:
    """Accented characters and their base characters, by Unicode decomposition."""
    plain = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            plain[chr(code)] = base
    return "".join(plain), "".join(plain.values())


def strip_accents(c: Column | str) -> Column:
    source, target = accents()
    return F.translate(F.col(c) if isinstance(c, str) else c, source, target)


def analyze(text: Column, bigrams: bool = True, min_length: int = 2) -> Column:
    """Lower-cased words of at least ``min_length`` characters, and each pair of neighbours."""
    words = F.filter(word_tokens(F.lower(text)), lambda w: F.length(w) >= min_length)
    if not bigrams:
        return words
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def _counts(terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms, how often each occurs, and how many owners have it."""
    known, at, tf = np.unique(terms, return_inverse=True, return_counts=True)
    held = np.unique(owner * max(len(known), 1) + at) % max(len(known), 1)
    return known, tf, np.bincount(held, minlength=len(known))


def _term_counts(batches, bigrams: bool):
    """(term, tf, df) of each block of word lists; a block has BLOCK_WORDS words at most, or one list."""
    for batch in batches:
        lists, at = batch.column("words"), 0
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < len(lists):
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_WORDS, "right")), at + 1)
            part, at = lists.slice(at, to - at), to
            coded = part.flatten().dictionary_encode()
            codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            owner = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
            known, tf, df = _counts(codes, owner)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(known)), pa.array(tf), pa.array(df)], names=["term", "tf", "df"])
            if bigrams and len(codes) > 1:
                same = owner[1:] == owner[:-1]
                known, tf, df = _counts((codes[:-1] * len(names) + codes[1:])[same], owner[1:][same])
                pairs = pc.binary_join_element_wise(names.take(pa.array(known // len(names))), names.take(pa.array(known % len(names))), " ")
                yield pa.RecordBatch.from_arrays([pairs, pa.array(tf), pa.array(df)], names=["term", "tf", "df"])


def tfidf_terms(
    df: DataFrame, text: Column, min_df: int = 3, max_df: float = 1.0, max_features: int | None = None,
    bigrams: bool = True,
) -> DataFrame:
    """Vocabulary table: term without accents, frequency, document frequency and smooth idf + 1.

    Tasks count the terms of a block of texts at once, each distinct word a number, so a task sends one row per
    term and block and not one per occurrence.
    """
    n_docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    words = df.select(analyze(strip_accents(text), bigrams=False).alias("words"))
    counted = words.mapInArrow(partial(_term_counts, bigrams=bigrams), "term string, tf long, df long")
    table = counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    kept = table.withColumn("_n", n_docs).where((F.col("df") >= min_df) & (F.col("df") <= F.col("_n") * max_df))
    scored = kept.withColumn("idf", F.log((F.col("_n") + 1.0) / (F.col("df") + 1.0)) + 1.0).drop("_n")
    return scored if max_features is None else scored.orderBy(F.desc("tf"), "term").limit(max_features)


def tokenize(c: Column | str, stop_words: Sequence[str], letters_only: bool = True) -> Column:
    """Words of two letters or more without the stop words."""
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    words = F.regexp_extract_all(text, F.lit(r"(?U)\b[a-z][a-z]+\b" if letters_only else r"(?U)\b\w\w+\b"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words
