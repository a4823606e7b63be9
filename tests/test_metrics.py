"""Properties of the threshold and ranking metrics."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from sievework.operators import metrics


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    y = (rng.random(800) < 0.15).astype(int)
    s = np.clip(np.round(rng.normal(0.3 + 0.25 * y, 0.15), 3), 0, 1)
    s[::3] = 0.3  # a third of all scores are one value
    return s, y


@pytest.fixture(scope="module")
def scored(spark, data):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(*data)], "score double, y int").cache()


def test_sweep_counts(scored, data):
    s, y = data
    got = metrics.threshold_sweep(scored).orderBy("threshold").collect()
    assert len(got) == 201
    last = -1
    for i, r in enumerate(got):
        t = 0.0 + i * 0.005
        assert r["threshold"] == t and r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(y)
        assert (r["tp"], r["fp"]) == (int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum()))
        assert r["fn"] >= last
        last = r["fn"]


def test_scores_on_the_grid_are_counted_exactly(spark):
    grid = [0.05 + i * 0.01 for i in range(45)]
    df = spark.createDataFrame([(g, 1) for g in grid], "score double, y int")
    got = [r["tp"] for r in metrics.threshold_sweep(df, 0.05, 0.01, 45).orderBy("threshold").collect()]
    assert got == list(range(45, 0, -1))


def test_recall_threshold_is_the_highest(scored, data):
    s, y = data
    for r in metrics.threshold_for_recall(scored, [0.5, 0.8, 0.95, 1.0]).collect():
        recall = lambda t: ((s >= t) & (y == 1)).sum() / y.sum()
        assert recall(r["threshold"]) >= r["target"]
        higher = s[s > r["threshold"]]
        assert len(higher) == 0 or recall(higher.min()) < r["target"]


def test_auc(scored):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    want = evaluator.evaluate(scored.withColumn("y", F.col("y").cast("double")))
    assert abs(metrics.roc_auc(scored).first()["auc"] - want) < 1e-9


def test_average_precision(scored, data):
    s, y = data
    total, recall = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        p = y[s >= t].mean()
        r = y[s >= t].sum() / y.sum()
        total, recall = total + (r - recall) * p, r
    assert abs(metrics.average_precision(scored).first()["average_precision"] - total) < 1e-9


def test_report_adds_up(scored, data):
    s, y = data
    rows = {r["name"]: r for r in metrics.classification_report(scored, 0.4).collect()}
    assert rows["0"]["support"] + rows["1"]["support"] == len(y)
    assert abs(rows["accuracy"]["f1"] - ((s >= 0.4) == (y == 1)).mean()) < 1e-12
    assert abs(rows["weighted avg"]["recall"] - rows["accuracy"]["f1"]) < 1e-12


def test_costs(scored):
    sweep = metrics.cost_sweep(scored)
    best = metrics.constrained_threshold(sweep, 0.95).first()
    rows = [r for r in sweep.collect() if r["recall"] >= 0.95]
    assert best["total_cost"] == min(r["total_cost"] for r in rows)
    none = metrics.constrained_threshold(sweep, 1.5).first()
    assert none["recall"] == max(r["recall"] for r in sweep.collect())
    balance = metrics.balanced_threshold(sweep).first()
    assert balance["gap"] == min(abs(r["fn"] - r["fp"]) for r in sweep.collect())


def test_no_positives(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 0)], "score double, y int")
    assert metrics.roc_auc(df).first()["auc"] is None
    assert metrics.classification_report(df, 0.3).where("name = '1'").first()["f1"] == 0.0
    assert metrics.threshold_sweep_desc(df).first()["threshold"] == 0.0
    assert metrics.threshold_for_recall(df, [0.8]).first()["threshold"] == 0.2


def test_histogram_has_area_one(scored):
    rows = metrics.score_histogram(scored, 50).collect()
    for y in (0, 1):
        assert abs(sum(r["density"] for r in rows if r["y"] == y) * 0.02 - 1) < 1e-9
