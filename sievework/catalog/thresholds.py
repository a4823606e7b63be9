"""Threshold, cost and ranking metrics."""

from __future__ import annotations

from sievework.catalog.base import SCORED, query, with_
from sievework.operators import metrics

MATRIX = """m AS (SELECT count(CASE WHEN score >= 0.5 AND y = 1 THEN 1 END) AS tp, count(CASE WHEN score >= 0.5 AND y = 0 THEN 1 END) AS fp,
 count(CASE WHEN score < 0.5 AND y = 1 THEN 1 END) AS fn, count(CASE WHEN score < 0.5 AND y = 0 THEN 1 END) AS tn FROM scored)"""


def sweep_sql(name: str, start: str, step: str, n: int) -> str:
    return f"""{name} AS (SELECT t AS threshold, count(CASE WHEN score >= t AND y = 1 THEN 1 END) AS tp,
 count(CASE WHEN score >= t AND y = 0 THEN 1 END) AS fp, count(CASE WHEN score < t AND y = 1 THEN 1 END) AS fn,
 count(CASE WHEN score < t AND y = 0 THEN 1 END) AS tn
 FROM (SELECT {start}::DOUBLE + i * {step}::DOUBLE AS t FROM range({n}) r(i)), scored GROUP BY 1)"""


SWEEP = sweep_sql("sweep", "0.0", "0.005", 201)
COSTS = sweep_sql("grid", "0.05", "0.01", 45) + """,
costs AS (SELECT threshold, tp, fp, fn, tn, tp + fp AS predicted_positive, fn + tn AS predicted_negative,
 fn * 50000 AS fn_cost, fp * 50 AS fp_cost, fn * 50000 + fp * 50 AS total_cost,
 coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
 coalesce(fn::DOUBLE / nullif(tp + fn, 0), 0) AS miss_rate FROM grid)"""
CURVE = """curve AS (SELECT score AS threshold, pos, neg, tp, fp, tp::DOUBLE / (tp + fp) AS precision,
  tp::DOUBLE / (SELECT sum(y) FROM scored) AS recall,
  fp::DOUBLE / (SELECT sum(1 - y) FROM scored) AS fpr
 FROM (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
  FROM (SELECT score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM scored GROUP BY 1)
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)))"""


@query("confusion_matrix", with_(SCORED, MATRIX, select="SELECT * FROM m"))
def _(t):
    return metrics.confusion_matrix(t.scored, 0.5)


@query("classification_report", with_(SCORED, MATRIX, """
c AS (SELECT *, coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0, coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0,
 coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1,
 tn + fp AS s0, tp + fn AS s1, tp + fp + fn + tn AS n FROM m),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM c)""", select="""
SELECT '0' AS name, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', (tp + tn)::DOUBLE / n, (tp + tn)::DOUBLE / n, (tp + tn)::DOUBLE / n, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f"""))
def _(t):
    return metrics.classification_report(t.scored, 0.5)


@query("threshold_sweep", with_(SCORED, SWEEP, select="""
SELECT *, tp + fp AS predicted_positive, fn + tn AS predicted_negative FROM sweep"""))
def _(t):
    return metrics.threshold_sweep(t.scored)


@query("cost_sweep", with_(SCORED, COSTS, select="SELECT * FROM costs"))
def _(t):
    return metrics.cost_sweep(t.scored)


@query("cost_ratio_argmin", with_(SCORED, SWEEP, select="""
SELECT ratio, threshold, fn, fp, fn * ratio + fp AS cost FROM sweep, (VALUES (1), (10), (25), (50), (100), (200)) r(ratio)
QUALIFY row_number() OVER (PARTITION BY ratio ORDER BY fn * ratio + fp, threshold) = 1"""))
def _(t):
    return metrics.cost_ratio_argmin(metrics.threshold_sweep(t.scored))


@query("balanced_threshold", with_(SCORED, SWEEP, select="""
SELECT threshold, fn, fp, abs(fn - fp) AS gap FROM sweep ORDER BY gap, threshold LIMIT 1"""))
def _(t):
    return metrics.balanced_threshold(metrics.threshold_sweep(t.scored))


@query("pr_curve", with_(SCORED, CURVE, select="SELECT threshold, pos, neg, tp, fp, precision, recall FROM curve"))
def _(t):
    return metrics.pr_curve(t.scored)


@query("threshold_for_recall", with_(SCORED, CURVE, select="""
SELECT target, coalesce(max(CASE WHEN recall >= target THEN threshold END), min(threshold)) AS threshold
FROM curve, (VALUES (0.80::DOUBLE), (0.85), (0.90)) v(target) GROUP BY 1"""))
def _(t):
    return metrics.threshold_for_recall(t.scored)


@query("threshold_sweep_desc", with_(SCORED, sweep_sql("sweep", "0.0", "0.01", 101), select="""
SELECT coalesce(max(CASE WHEN tp::DOUBLE / (tp + fn) >= 0.8 THEN threshold END), 0.0) AS threshold FROM sweep"""))
def _(t):
    return metrics.threshold_sweep_desc(t.scored)


@query("constrained_threshold", with_(SCORED, COSTS, select="""
SELECT threshold, recall, total_cost, fn, fp FROM costs
ORDER BY CASE WHEN recall >= 0.95 THEN 0 ELSE 1 END, CASE WHEN recall >= 0.95 THEN total_cost ELSE -recall END, threshold LIMIT 1"""))
def _(t):
    return metrics.constrained_threshold(metrics.cost_sweep(t.scored))


@query("f1_threshold", with_(SCORED, CURVE, select="""
SELECT threshold, precision, recall, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM curve ORDER BY f1 DESC, threshold LIMIT 1"""))
def _(t):
    return metrics.f1_threshold(t.scored)


@query("average_precision", with_(SCORED, CURVE, select="""
SELECT sum((recall - before_r) * precision) AS average_precision, sum((recall - before_r) * (precision + before_p) / 2) AS pr_area
FROM (SELECT *, coalesce(lag(recall) OVER (ORDER BY threshold DESC), 0.0) AS before_r,
 coalesce(lag(precision) OVER (ORDER BY threshold DESC), 1.0) AS before_p FROM curve)"""))
def _(t):
    return metrics.average_precision(t.scored)


@query("roc_curve", with_(SCORED, CURVE, select="SELECT threshold, pos, neg, tp, fp, recall AS tpr, fpr FROM curve"))
def _(t):
    return metrics.roc_curve(t.scored)


@query("roc_auc", with_(SCORED, select="""
SELECT sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*) AS auc
FROM scored a, scored b WHERE a.y = 1 AND b.y = 0"""))
def _(t):
    return metrics.roc_auc(t.scored)


def histogram_sql(bins: int, low: str, high: str) -> str:
    width = f"(({high}::DOUBLE - {low}::DOUBLE) / {bins})"
    return f"""SELECT y, bin, count(*) AS n, count(*) / (sum(count(*)) OVER (PARTITION BY y) * {width}) AS density FROM (
 SELECT y, least((SELECT max(i) FROM range({bins + 1}) r(i) WHERE {low}::DOUBLE + i * {width} <= score), {bins - 1}) AS bin
 FROM scored WHERE score BETWEEN {low}::DOUBLE AND {high}::DOUBLE) GROUP BY y, bin"""


@query("score_histogram", with_(SCORED, select=histogram_sql(50, "0.0", "1.0")))
def _(t):
    return metrics.score_histogram(t.scored)


@query("score_histogram_zoom", with_(SCORED, select=histogram_sql(100, "0.3", "0.5")))
def _(t):
    return metrics.score_histogram(t.scored, 100, 0.3, 0.5)


@query("metrics_at_thresholds", with_(SCORED, select="""
SELECT t AS threshold, tp, fp, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(p, 0), 0) AS recall
FROM (SELECT t, count(CASE WHEN y = 1 THEN 1 END) AS p, count(CASE WHEN score >= t AND y = 1 THEN 1 END) AS tp,
 count(CASE WHEN score >= t AND y = 0 THEN 1 END) AS fp
 FROM scored, (VALUES (0.05::DOUBLE), (0.1), (0.2), (0.3), (0.4), (0.5)) v(t) GROUP BY 1)"""))
def _(t):
    return metrics.metrics_at_thresholds(t.scored, [0.05, 0.1, 0.2, 0.3, 0.4, 0.5])


@query("error_cost", with_(SCORED, MATRIX, select="""
SELECT fn, fp, fn * 50000 AS fn_cost, fp * 50 AS fp_cost, fn * 50000 + fp * 50 AS total_cost,
 coalesce((fn * 50000)::DOUBLE / nullif(fn * 50000 + fp * 50, 0), 0) AS missed_share FROM m"""))
def _(t):
    return metrics.error_cost(metrics.confusion_matrix(t.scored, 0.5))


@query("threshold_delta", with_(SCORED, COSTS, select="""
SELECT a.threshold AS current_threshold, b.threshold AS chosen_threshold, b.fn - a.fn AS fn_change, b.fp - a.fp AS fp_change,
 b.total_cost - a.total_cost AS cost_change
FROM (SELECT * FROM costs ORDER BY abs(threshold - 0.21), threshold LIMIT 1) a,
 (SELECT * FROM costs ORDER BY CASE WHEN recall >= 0.95 THEN 0 ELSE 1 END,
   CASE WHEN recall >= 0.95 THEN total_cost ELSE -recall END, threshold LIMIT 1) b"""))
def _(t):
    sweep = metrics.cost_sweep(t.scored)
    return metrics.threshold_delta(sweep, 0.21, metrics.constrained_threshold(sweep))
