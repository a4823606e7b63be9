"""From a labelled frame to a model, its out-of-fold scores and the threshold to run it at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.operators import metrics, ml
from sievework.session import cut_lineage


def choose_threshold(
    scored: DataFrame, min_recall: float = 0.95, missed_cost: float = fv.MISSED_COST, review_cost: float = fv.REVIEW_COST
) -> DataFrame:
    """One row: the cheapest threshold that keeps the recall, with what it misses and costs."""
    sweep = metrics.cost_sweep(scored, missed_cost=missed_cost, review_cost=review_cost)
    return metrics.constrained_threshold(sweep, min_recall)


def train_and_choose(
    train: ml.Trainer, labelled: DataFrame, folds: int = 5, min_recall: float = 0.95
) -> tuple[object, float, DataFrame]:
    """(model fitted on all rows, threshold from out-of-fold scores, metric rows at it)."""
    scored = cut_lineage(ml.as_scored(ml.oof_predictions(train, labelled, folds)))
    threshold = choose_threshold(scored, min_recall).first()["threshold"]
    return train(labelled), threshold, metrics.metric_rows(scored, threshold)


def missed(scored: DataFrame, key: str, threshold: float) -> DataFrame:
    """The positives a threshold misses, lowest score first."""
    return scored.where((F.col("y") == 1) & (F.col("score") < threshold)).orderBy("score", key)
