"""Threshold, cost and ranking metrics of a scored table.

Everything starts from counts per score (or per grid cell), which one partial aggregation gives;
what follows runs on that smaller frame. A scored table has a ``score`` and a 0/1 label ``y``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework import fixed_values as fv
from sievework.operators.running import running_totals

COUNTS = ("tp", "fp", "fn", "tn")


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def score_counts(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy("score").agg(F.sum("y").cast("bigint").alias("pos"), F.sum(1 - F.col("y")).cast("bigint").alias("neg"))


def confusion_matrix(scored: DataFrame, threshold: float) -> DataFrame:
    p, y = F.col("score") >= threshold, F.col("y") == 1
    return scored.agg(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"),
    )


def classification_report(scored: DataFrame, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted mean."""
    m = confusion_matrix(scored, threshold)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in COUNTS)

    def row(name, precision, recall, support):
        f1 = ratio(2 * precision * recall, precision + recall)
        return F.struct(
            F.lit(name).alias("name"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    n = tp + fp + fn + tn
    zero = (ratio(tn, tn + fn), ratio(tn, tn + fp), tn + fp)
    one = (ratio(tp, tp + fp), ratio(tp, tp + fn), tp + fn)
    f1 = lambda c: ratio(2 * c[0] * c[1], c[0] + c[1])
    accuracy = ratio(tp + tn, n)

    def mean(name, w0, w1):
        parts = [ratio(a * w0 + b * w1, w0 + w1) for a, b in ((zero[0], one[0]), (zero[1], one[1]), (f1(zero), f1(one)))]
        return F.struct(
            F.lit(name).alias("name"), parts[0].alias("precision"), parts[1].alias("recall"), parts[2].alias("f1"),
            n.cast("bigint").alias("support"),
        )

    same = F.struct(
        F.lit("accuracy").alias("name"), accuracy.alias("precision"), accuracy.alias("recall"), accuracy.alias("f1"),
        n.cast("bigint").alias("support"),
    )
    rows = F.array(
        row("0", *zero), row("1", *one), same, mean("macro avg", F.lit(1.0), F.lit(1.0)),
        mean("weighted avg", zero[2], one[2]),
    )
    return m.select(F.explode(rows).alias("r")).select("r.*")


def grid_cell(score: Column, start: float, step: float) -> Column:
    """Index of the highest grid threshold ``start + i * step`` that is not above the score.

    The division may miss by one in the last bit, so the neighbours are compared exactly.
    """
    guess = F.floor((score - start) / step)
    at = lambda i: F.lit(start) + i * F.lit(step)
    return F.when(at(guess + 1) <= score, guess + 1).when(at(guess) > score, guess - 1).otherwise(guess)


def threshold_sweep(scored: DataFrame, start: float = 0.0, step: float = 0.005, n: int = 201) -> DataFrame:
    """Confusion counts at every threshold of a grid from one pass over the scores.

    Scores fall into at most ``n`` + 1 cells; the running sums are over those few rows.
    """
    cell = F.least(F.greatest(grid_cell(F.col("score"), start, step), F.lit(-1)), F.lit(n - 1)).cast("int")
    cells = scored.groupBy(cell.alias("i")).agg(
        F.sum("y").cast("bigint").alias("pos"), F.sum(1 - F.col("y")).cast("bigint").alias("neg")
    )
    grid = scored.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("i"))
    filled = grid.join(cells, "i", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    summed = filled.select(
        "i",
        F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
    ).where("i >= 0")
    return summed.select(
        (F.lit(start) + F.col("i") * F.lit(step)).alias("threshold"), *COUNTS,
        (F.col("tp") + F.col("fp")).alias("predicted_positive"),
        (F.col("fn") + F.col("tn")).alias("predicted_negative"),
    )


def cost_sweep(
    scored: DataFrame, start: float = 0.05, step: float = 0.01, n: int = 45,
    missed_cost: float = fv.MISSED_COST, review_cost: float = fv.REVIEW_COST,
) -> DataFrame:
    """Cost of missed and of needless cases at each threshold."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return threshold_sweep(scored, start, step, n).withColumns({
        "fn_cost": fn * F.lit(missed_cost), "fp_cost": fp * F.lit(review_cost),
        "total_cost": fn * F.lit(missed_cost) + fp * F.lit(review_cost),
        "recall": ratio(tp, tp + fn), "precision": ratio(tp, tp + fp), "miss_rate": ratio(fn, tp + fn),
    })


def cost_ratio_argmin(sweep: DataFrame, ratios: Sequence[int] = fv.COST_RATIOS) -> DataFrame:
    """Cheapest threshold for each price of a miss; the lowest wins ties."""
    each = sweep.withColumn("ratio", F.explode(F.array(*[F.lit(r) for r in ratios])))
    cost = F.col("fn") * F.col("ratio") + F.col("fp")
    best = each.withColumn("cost", cost).groupBy("ratio").agg(
        F.min_by(F.struct("threshold", "fn", "fp", "cost"), F.struct("cost", "threshold")).alias("b")
    )
    return best.select("ratio", "b.*")


def pick_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The one row that comes first in ``order``, as an aggregate."""
    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    return df.agg(F.min_by(F.struct(*df.columns), F.struct(*named)).alias("_row")).select("_row.*")


def balanced_threshold(sweep: DataFrame) -> DataFrame:
    """Where misses and false alarms are closest in number."""
    gaps = sweep.withColumn("gap", F.abs(F.col("fn") - F.col("fp")))
    return pick_row(gaps.select("threshold", "fn", "fp", "gap"), [F.col("gap"), F.col("threshold")])


def pr_curve(scored: DataFrame, slices: int = 64) -> DataFrame:
    """Precision and recall at every distinct score."""
    totals = running_totals(score_counts(scored), "score", ["pos", "neg"], slices=slices)
    positives = scored.agg(F.sum("y").cast("bigint").alias("p")).scalar()
    return totals.select(
        F.col("score").alias("threshold"), "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio(F.col("cum_pos"), positives).alias("recall"),
    )


def threshold_for_recall(scored: DataFrame, targets: Sequence[float] = (0.80, 0.85, 0.90)) -> DataFrame:
    """Highest score that still reaches each recall; the lowest score if none does."""
    curve = pr_curve(scored)
    hit = curve.withColumn("target", F.explode(F.array(*[F.lit(float(t)) for t in targets])))
    return hit.groupBy("target").agg(
        F.coalesce(F.max(F.when(F.col("recall") >= F.col("target"), F.col("threshold"))), F.min("threshold")).alias("threshold")
    )


def threshold_sweep_desc(scored: DataFrame, target: float = 0.8, step: float = 0.01) -> DataFrame:
    """Highest grid threshold that reaches the recall, 0 if none does."""
    n = round(1.0 / step) + 1
    sweep = threshold_sweep(scored, 0.0, step, n)
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sweep.agg(F.coalesce(F.max(F.when(recall >= target, F.col("threshold"))), F.lit(0.0)).alias("threshold"))


def constrained_threshold(costs: DataFrame, min_recall: float = 0.95) -> DataFrame:
    """Cheapest threshold with enough recall; without any, the one with most recall."""
    enough = F.col("recall") >= min_recall
    return pick_row(
        costs.select("threshold", "recall", "total_cost", "fn", "fp"),
        [
            F.when(enough, 0).otherwise(1),
            F.when(enough, F.col("total_cost")).otherwise(-F.col("recall")),
            F.col("threshold"),
        ],
    )


def f1_threshold(scored: DataFrame) -> DataFrame:
    """Score with the best F1."""
    p, r = F.col("precision"), F.col("recall")
    curve = pr_curve(scored).withColumn("f1", 2 * p * r / (p + r + F.lit(1e-8)))
    return pick_row(curve.select("threshold", "precision", "recall", "f1"), [-F.col("f1"), F.col("threshold")])


def average_precision(scored: DataFrame) -> DataFrame:
    """Average precision, and the area under the curve by trapezoids from (0, 1) on."""
    curve = pr_curve(scored)
    step = F.col("pos") / F.nullif((F.col("tp") / F.nullif(F.col("recall"), F.lit(0.0))), F.lit(0.0))
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.when(tp0 + fp0 == 0, 1.0).otherwise(ratio(tp0, tp0 + fp0))
    return curve.agg(
        F.sum(F.coalesce(step * F.col("precision"), F.lit(0.0))).alias("average_precision"),
        F.sum(F.coalesce(step * (F.col("precision") + before) / 2.0, F.lit(0.0))).alias("pr_area"),
    )


def roc_curve(scored: DataFrame, slices: int = 64) -> DataFrame:
    """True and false positive rate at every distinct score."""
    totals = running_totals(score_counts(scored), "score", ["pos", "neg"], slices=slices)
    whole = scored.agg(F.sum("y").cast("bigint").alias("p"), F.sum(1 - F.col("y")).cast("bigint").alias("n"))
    one = whole.select(F.struct("p", "n").alias("w")).scalar()
    return totals.withColumn("_w", one).select(
        F.col("score").alias("threshold"), "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        ratio(F.col("cum_pos"), F.col("_w.p")).alias("tpr"), ratio(F.col("cum_neg"), F.col("_w.n")).alias("fpr"),
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties one half."""
    totals = running_totals(score_counts(scored), "score", ["pos", "neg"])
    better = F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0
    pairs = F.nullif(F.sum("pos").cast("double") * F.sum("neg").cast("double"), F.lit(0.0))
    return totals.agg((F.sum(F.col("neg") * better) / pairs).alias("auc"))


def score_histogram(scored: DataFrame, bins: int = 50, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Counts and densities per class and bin; the last bin includes its upper edge."""
    width = (high - low) / bins
    inside = scored.where(F.col("score").between(low, high))
    i = F.least(grid_cell(F.col("score"), low, width), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy("y", i.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("y"))  # at most `bins` rows per class
    return counts.withColumn("density", F.col("n") / (total * F.lit(width)))


def metrics_at_thresholds(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Counts, precision and recall at a short list of thresholds, one pass."""
    ordered = sorted(thresholds)
    p, y = F.col("score"), F.col("y") == 1
    aggs = [F.count_if(y).alias("_p")]
    for i, t in enumerate(ordered):
        aggs += [F.count_if((p >= t) & y).alias(f"tp{i}"), F.count_if((p >= t) & ~y).alias(f"fp{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
            ratio(F.col(f"tp{i}"), F.col(f"tp{i}") + F.col(f"fp{i}")).alias("precision"),
            ratio(F.col(f"tp{i}"), F.col("_p")).alias("recall"),
        )
        for i, t in enumerate(ordered)
    ])
    return scored.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def error_cost(matrix: DataFrame, missed_cost: float = fv.MISSED_COST, review_cost: float = fv.REVIEW_COST) -> DataFrame:
    """Cost of the errors of a confusion matrix and the part that misses cause."""
    fn_cost, fp_cost = F.col("fn") * F.lit(missed_cost), F.col("fp") * F.lit(review_cost)
    return matrix.select(
        "fn", "fp", fn_cost.alias("fn_cost"), fp_cost.alias("fp_cost"), (fn_cost + fp_cost).alias("total_cost"),
        ratio(fn_cost, fn_cost + fp_cost).alias("missed_share"),
    )


def threshold_delta(sweep: DataFrame, current: float, chosen: DataFrame) -> DataFrame:
    """Change from the current threshold's row to the chosen row.

    The current row is the sweep row closest to ``current``, the lower one on ties. Both sides
    are single rows and meet as scalars.
    """
    wanted = ["threshold", "fn", "fp", "total_cost"]
    now = pick_row(sweep.select(*wanted), [F.abs(F.col("threshold") - current), F.col("threshold")])
    then = now.select(F.struct(*wanted).alias("s")).scalar()
    return chosen.select(F.struct(*wanted).alias("best")).withColumn("now", then).select(
        F.col("now.threshold").alias("current_threshold"), F.col("best.threshold").alias("chosen_threshold"),
        (F.col("best.fn") - F.col("now.fn")).alias("fn_change"),
        (F.col("best.fp") - F.col("now.fp")).alias("fp_change"),
        (F.col("best.total_cost") - F.col("now.total_cost")).alias("cost_change"),
    )


def metric_rows(scored: DataFrame, threshold: float) -> DataFrame:
    """(metric, value) rows of one model at one threshold."""
    m = confusion_matrix(scored, threshold)
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    values = {
        "threshold": F.lit(float(threshold)), "precision": p, "recall": r, "f1": ratio(2 * p * r, p + r),
        "to_review": tp + fp, "missed": fn, "false_alarms": fp, "workload": ratio(tp + fp, tp + fp + fn + tn),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()])
    return m.select(F.explode(rows).alias("r")).select("r.*")


def compare_metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two models side by side with their difference."""
    left, right = a.withColumnRenamed("value", "first"), b.withColumnRenamed("value", "second")
    return left.join(right, "metric").withColumn("difference", F.col("second") - F.col("first"))
