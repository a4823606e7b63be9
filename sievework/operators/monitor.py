"""Counts, shares and profiles that watch the store and describe a data set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework import fixed_values as fv
from sievework.functions.clean import is_blank
from sievework.operators.joins import has_url, mark_processed
from sievework.operators.running import bracketed_quantiles

# The words of the store for a finished and a failed text.
STATUS_WORDS = {"success": "COMPLETED", "failed": "failed"}


def grand_total(column: str) -> Column:
    """Sum over all rows; only ever used on a handful of grouped rows."""
    return F.sum(column).over(Window.partitionBy())


def share(part: Column, whole: Column, places: int = 2) -> Column:
    """Percentage, NULL when the whole is 0."""
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), places)


def unpivot_row(one_row: DataFrame, names: Sequence[str], measures: Sequence[str], label: str = "column") -> DataFrame:
    """One wide row ``<measure>__<name>`` to one row per name."""
    rows = F.array(*[
        F.struct(F.lit(n).alias(label), *[F.col(f"`{m}__{n}`").alias(m) for m in measures]) for n in names
    ])
    return one_row.select(F.explode(rows).alias("r")).select("r.*")


# -- counts over the store ------------------------------------------------------------------------

def count_by_label(notices: DataFrame) -> DataFrame:
    return notices.where(F.col("bid").isNotNull()).groupBy("bid").agg(F.count(F.lit(1)).alias("n"))


def doc_status_summary(doc_content: DataFrame, as_of: str, done: str = STATUS_WORDS["success"]) -> DataFrame:
    hour_ago = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    return doc_content.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("processing_status") == done).alias("completed_records"),
        F.max("extraction_timestamp").alias("latest_extraction"),
        F.count_if(F.col("extraction_timestamp") >= hour_ago).alias("processed_last_hour"),
    )


def url_availability(notices: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return notices.agg(
        total.alias("total"),
        F.count_if(has_url()).alias("with_url"),
        F.count_if(~has_url()).alias("without_url"),
        share(F.count_if(has_url()), total).alias("availability_pct"),
    )


def migration_audit(notices: DataFrame) -> DataFrame:
    """Eighteen counts of a migrated table in one pass."""
    count = lambda c, name: F.count(F.col(c)).alias(name)
    return notices.agg(
        F.count(F.lit(1)).alias("total_records"),
        count("published", "published_dates"),
        count("deadline", "deadline_dates"),
        count("awarddate", "award_dates"),
        count("value", "valid_values"),
        count("bid", "labelled_records"),
        count("ml_processed", "ml_processed_count"),
        count("ml_bid", "ml_predicted_count"),
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.count_if(F.col("bid") == 1).alias("positive_labels"),
        F.count_if(F.col("bid") == 0).alias("negative_labels"),
        F.count_if(F.col("ml_bid")).alias("ml_positive_predictions"),
        F.count_if(~F.col("ml_bid")).alias("ml_negative_predictions"),
        F.count_if(F.col("ml_processed")).alias("ml_processed_records"),
        F.count_if(F.col("ml_status") == "bid").alias("bid_status_count"),
        F.count_if(F.col("ml_status") == "no-bid").alias("no_bid_status_count"),
        F.count_if(F.col("ml_status") == "pending").alias("pending_status_count"),
    )


def notification_totals(notices: DataFrame) -> DataFrame:
    sent = F.coalesce(F.col("notification_sent"), F.lit(False))
    return notices.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(sent).alias("notified"), F.count_if(~sent).alias("pending")
    )


def notice_statistics(notices: DataFrame, as_of: str) -> DataFrame:
    """Total, open, closed and recent notices in one pass."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS")
    return notices.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status").ilike("%open%")).alias("open"),
        F.count_if(F.col("status").ilike("%closed%")).alias("closed"),
        F.count_if(F.col("published") >= since).alias("recent"),
    )


def counts_desc(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, the value as tie-break."""
    rows = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))
    return rows if limit is None else rows.limit(limit)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def doc_status(words: Mapping[str, str] = STATUS_WORDS) -> Column:
    """Where a notice stands on its way to a text; reads the joined row."""
    status = F.col("processing_status")
    return (
        F.when(~has_url(), "No PDF URL")
        .when(F.col("_doc_key").isNull(), "PDF Not Processed")
        .when(status == words["success"], "Successfully Processed")
        .when(status == words["failed"], "Processing Failed")
        .otherwise(F.coalesce(status, F.lit("Unknown")))
    )


def _with_doc(notices: DataFrame, doc_content: DataFrame, columns: Sequence[str]) -> DataFrame:
    docs = doc_content.select("resource_id", F.col("resource_id").alias("_doc_key"), *columns)
    return notices.join(docs, "resource_id", "left")


def doc_status_rows(notices: DataFrame, doc_content: DataFrame, since: str) -> DataFrame:
    recent = notices.where(F.col("published") >= F.lit(since).cast("timestamp_ntz"))
    texts = doc_content.withColumn("text_length", F.length("pdf_text"))
    joined = _with_doc(recent, texts, ["processing_status", "extraction_timestamp", "text_length"])
    return joined.select(
        "resource_id", "title", "ca", "published", "deadline", doc_status().alias("doc_status"),
        "extraction_timestamp", "text_length",
    ).orderBy(F.col("published").desc_nulls_first(), "resource_id")


def status_funnel(notices: DataFrame, doc_content: DataFrame, since: str) -> DataFrame:
    """Notices per document status with their share of all."""
    recent = notices.where(F.col("published") >= F.lit(since).cast("timestamp_ntz"))
    counts = _with_doc(recent, doc_content, ["processing_status"]).groupBy(doc_status().alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.withColumn("percentage", share(F.col("n"), grand_total("n"))).orderBy(F.desc("n"), "status")


def hourly_activity(
    docs: DataFrame, ts: str, success: Column, failed: Column, since: Column | None = None
) -> DataFrame:
    rows = docs if since is None else docs.where(F.col(ts) >= since)
    return rows.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(success).alias("successful"),
        F.count_if(failed).alias("failed"),
    ).orderBy(F.col("hour").desc_nulls_first())


def authority_rate(notices: DataFrame, doc_content: DataFrame, since: str) -> DataFrame:
    """Processing rate per authority with more than one notice, lowest first."""
    recent = notices.where(F.col("published") >= F.lit(since).cast("timestamp_ntz"))
    marked = mark_processed(recent.select("resource_id", "ca", "pdf_url"), doc_content)
    grouped = marked.groupBy("ca").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has_url()).alias("with_url"),
        F.count_if("has_doc").alias("processed"),
    )
    rated = grouped.where(F.col("total") > 1).withColumn("rate_pct", share(F.col("processed"), F.col("with_url")))
    return rated.orderBy(F.col("rate_pct").asc_nulls_last(), F.desc("total"), "ca")


def load_checkpoint(notices: DataFrame, doc_content: DataFrame, tag: str = "Before Dataload") -> DataFrame:
    """State of the store under a tag, to append to a table of snapshots."""
    marked = mark_processed(notices.select("resource_id", "published", "pdf_url"), doc_content)
    return marked.agg(
        F.lit(tag).alias("checkpoint"),
        F.count(F.lit(1)).alias("total_records"),
        F.max("published").alias("latest_published"),
        F.count_if(has_url()).alias("records_with_url"),
        F.count_if(has_url() & ~F.col("has_doc")).alias("pending_documents"),
    )


def daily_counts(df: DataFrame, ts: str, key: str, since: Column, approximate: bool = False) -> DataFrame:
    """Rows and distinct keys per day, newest first."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.where(F.col(ts) > since).groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), distinct.alias("n_keys")
    ).orderBy(F.desc("day"))


def flag_counts(df: DataFrame, flag: Column) -> DataFrame:
    return df.groupBy(flag.alias("flag")).agg(F.count(F.lit(1)).alias("n"))


def prediction_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count(column).alias("predicted"), F.avg(column).alias("avg_probability")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def category_volumes(df: DataFrame, column: str = "category") -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / grand_total("n")).orderBy(column)


def ingest_counters(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """How many rows reached each stage, in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in stages.items()])


# -- codes ----------------------------------------------------------------------------------------

def available_codes(df: DataFrame) -> DataFrame:
    return df.select(F.explode("detected_codes").alias("code")).distinct().orderBy("code")


def code_statistics(df: DataFrame) -> DataFrame:
    """Documents per code and their share of all rows, most frequent first."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.select(F.explode("detected_codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percentage", F.col("n") * 100.0 / total).orderBy(F.desc("n"), "code")


def frequency_bands(counts: DataFrame, bands=fv.FREQUENCY_BANDS) -> DataFrame:
    """How many codes fall in each band of frequency."""
    band = F.lit(None).cast("string")
    for name, low, high in bands:
        inside = F.col("n") >= low if high is None else F.col("n").between(low, high)
        band = F.when(inside, name).otherwise(band)
    return counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_codes"))


def code_sparsity(df: DataFrame) -> DataFrame:
    """Filled share of the rows x codes matrix without building it."""
    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size("detected_codes")).alias("n_set"),
        F.avg(F.size("detected_codes")).alias("avg_codes"),
    )
    n_codes = df.select(F.explode("detected_codes").alias("c")).agg(F.count_distinct("c").alias("n")).scalar()
    cells = F.nullif(F.col("n_rows") * F.col("n_codes"), F.lit(0))
    return one.withColumn("n_codes", n_codes).withColumn("density", F.col("n_set") / cells).withColumn(
        "sparsity", 1.0 - F.col("density")
    )


def top_codes(df: DataFrame, k: int = 5) -> list[str]:
    """The ``k`` most frequent codes, by code on ties; a list of at most ``k`` strings."""
    return [r["code"] for r in code_statistics(df).limit(k).collect()]


def code_flags(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One 0/1 column per given code, named by its place."""
    return df.withColumns({
        f"code_{i}": F.array_contains("detected_codes", c).cast("int") for i, c in enumerate(codes, 1)
    })


# -- profiles -------------------------------------------------------------------------------------

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def quantile_columns(df: DataFrame, columns: Sequence[str], fractions: Mapping[float, str], aggregates: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """One row per column with its exact quantiles, and one row of ``aggregates``, from the same passes."""
    found, one = bracketed_quantiles(df, columns, list(fractions), aggregates)
    return found.groupBy("column").agg(*[
        F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(name) for f, name in fractions.items()
    ]), one


def describe_columns(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        measures = {"n": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        if approximate:
            measures |= {name: F.percentile_approx(x, f) for f, name in QUARTILES.items()}
        aggs += [m.alias(f"{name}__{c}") for name, m in measures.items()]
    names = ["n", "mean", "std", "min", "max"]
    if approximate:
        return unpivot_row(df.agg(*aggs), columns, [*names, *QUARTILES.values()])
    quartiles, one = quantile_columns(df, columns, QUARTILES, aggs)
    return unpivot_row(one, columns, names).join(quartiles, "column", "left")


def length_buckets(df: DataFrame, column: str, bounds: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows per named condition and their share of all rows; conditions may overlap."""
    total = F.count(F.lit(1))
    aggs = [F.count_if(cond).alias(f"n__{name}") for name, cond in bounds]
    aggs += [(F.count_if(cond) / F.nullif(total, F.lit(0))).alias(f"share__{name}") for name, cond in bounds]
    return unpivot_row(df.agg(*aggs), [name for name, _ in bounds], ["n", "share"], "bucket")


def quality_profile(df: DataFrame, columns: Sequence[str], zero_limit: float = 0.5) -> DataFrame:
    """Missing, infinite and zero values per numeric column."""
    total = F.count(F.lit(1))
    aggs = [total.alias("_total")]
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count_if(x.isNull() | F.isnan(x)).alias(f"nulls__{c}"),
            F.count_if(F.abs(x) == float("inf")).alias(f"infinities__{c}"),
            F.count_if(x == 0.0).alias(f"zeros__{c}"),
        ]
    one = df.agg(*aggs)
    total = F.nullif(F.col("_total"), F.lit(0))
    one = one.withColumns({f"null_share__{c}": F.col(f"nulls__{c}") / total for c in columns} | {
        f"zero_share__{c}": F.col(f"zeros__{c}") / total for c in columns
    })
    rows = unpivot_row(one, columns, ["nulls", "infinities", "zeros", "null_share", "zero_share"])
    return rows.withColumn("mostly_zero", F.col("zero_share") > zero_limit)


def _pearson(pairs: Sequence[tuple[str, str, str]], df: DataFrame, label: str) -> DataFrame:
    """Correlations of named column pairs over the rows where both sides are present, in one pass.

    Covariance and deviations are stable aggregates; a constant column gives no row.
    """
    results = []
    for name, a, b in pairs:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        # A constant column may leave rounding dust of its size.
        moving = (F.stddev_pop(x) > F.max(F.abs(x)) * 1e-12) & (F.stddev_pop(y) > F.max(F.abs(y)) * 1e-12)
        results.append(F.when(moving, F.covar_pop(x, y) / spread).alias(f"corr__{name}"))
    rows = unpivot_row(df.agg(*results), [name for name, _, _ in pairs], ["corr"], label)
    return rows.where(F.col("corr").isNotNull())


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns."""
    pairs = [(f"{a}|{b}", a, b) for a, b in combinations(columns, 2)]
    rows = _pearson(pairs, df, "pair")
    sides = F.split("pair", r"\|")
    return rows.select(sides[0].alias("a"), sides[1].alias("b"), "corr")


def high_correlations(df: DataFrame, columns: Sequence[str], limit: float = 0.8) -> DataFrame:
    return correlations(df, columns).where(F.abs("corr") > limit)


def feature_label_corr(
    df: DataFrame, features: Sequence[str], label: str = "bid", k: int = 10
) -> DataFrame:
    """Features most correlated with the label."""
    rows = _pearson([(f, f, label) for f in features], df, "feature")
    return rows.orderBy(F.desc(F.abs("corr")), "feature").limit(k)


def crosstab_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of two columns with margins; NULL keys are left out as in the plain table."""
    kept = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cube = kept.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    name = lambda c, g: F.when(F.col(g) == 1, "All").otherwise(F.col(c).cast("string"))
    return cube.select(name(a, "_ga").alias(a), name(b, "_gb").alias(b), "n")


def bid_rate_by_flag(df: DataFrame, flag: str, label: str = "bid") -> DataFrame:
    with_flag = F.avg(F.when(F.col(flag) == 1, F.col(label)))
    without = F.avg(F.when(F.col(flag) == 0, F.col(label)))
    return df.agg(
        with_flag.alias("rate_with"), without.alias("rate_without"), (with_flag - without).alias("difference")
    )


def bid_rate_by(df: DataFrame, column: str, label: str = "bid") -> DataFrame:
    return df.groupBy(column).agg(
        F.count(label).alias("n"), F.round(F.avg(label), 3).alias("rate")
    ).orderBy(column)


def class_balance(df: DataFrame, label: str = "bid") -> DataFrame:
    """Class counts and shares, imbalance ratio and how severe it is."""
    total = F.nullif(F.count(label), F.lit(0))
    one = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
        (F.count_if(F.col(label) == 1) / total).alias("positive_share"),
        (F.count_if(F.col(label) == 0) / total).alias("negative_share"),
    )
    smaller = F.least("positive_share", "negative_share")
    return one.withColumns({
        "imbalance_ratio": F.greatest("positives", "negatives") / F.nullif(F.least("positives", "negatives"), F.lit(0)),
        "severity": F.when(smaller < 0.1, "severe").when(smaller < 0.2, "moderate").otherwise("balanced"),
    })


def text_profile(df: DataFrame, column: str, phrase: str, approximate: bool = False) -> DataFrame:
    """Length statistics of a text column and how many rows hold a phrase."""
    size = F.length(column)
    aggs = [
        F.min("size").alias("min_length"), F.max("size").alias("max_length"), F.avg("size").alias("mean_length"),
        F.count_if("phrase").alias("with_phrase"),
    ]
    sizes = df.select(size.alias("size"), F.lower(column).contains(phrase.lower()).alias("phrase"))
    if approximate:
        return sizes.agg(*aggs, F.percentile_approx(F.col("size").cast("double"), 0.5).alias("median_length"))
    medians, one = quantile_columns(sizes, ["size"], {0.5: "median"}, aggs)
    return one.withColumn("median_length", medians.agg(F.max("median").alias("m")).scalar())


def dataset_funnel(joined: DataFrame, min_text_length: int = 10) -> DataFrame:
    """Sizes of the labelled, text-bearing and modelling sets and their ratios.

    ``joined`` has the sizes of the texts (``text_sizes``) in place of the texts.
    """
    labelled = F.col("bid").isNotNull()
    text = labelled & (F.coalesce("text_chars", F.lit(0)) > 0)
    modelling = text & (F.col("pdf_text_length") >= min_text_length) & ~is_blank("title")
    one = joined.agg(
        F.count(F.lit(1)).alias("all_rows"), F.count_if(labelled).alias("labelled"),
        F.count_if(text).alias("with_text"), F.count_if(modelling).alias("modelling"),
    )
    return one.withColumns({
        "text_share": F.col("with_text") / F.nullif(F.col("labelled"), F.lit(0)),
        "modelling_share": F.col("modelling") / F.nullif(F.col("labelled"), F.lit(0)),
    })


def top_k(df: DataFrame, name: str, weight: str, k: int) -> DataFrame:
    """The ``k`` heaviest rows, by name on ties."""
    return df.orderBy(F.desc(weight), F.asc(name)).limit(k)


def top_k_per_group(df: DataFrame, group: str, name: str, weight: str, k: int) -> DataFrame:
    """The ``k`` heaviest rows of each group; a group is cut to ``k`` rows per task before it moves."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(weight), F.asc(name)))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)

