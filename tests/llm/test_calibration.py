"""The calibration of scores: the optimum over all rows, in few jobs."""

import numpy as np

from sievework.llm import toxicity


def plain(x, y):
    """The optimum by many small steps of Newton's method."""
    w = np.array([1.0, 0.0])
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -50, 50)))
        q = p * (1 - p)
        slope = np.array([((p - y) * x).sum(), (p - y).sum()]) + 1e-2 * (w - [1, 0])
        bend = np.array([[(q * x * x).sum(), (q * x).sum()], [(q * x).sum(), q.sum()]]) + 1e-2 * np.eye(2)
        w = w - np.clip(np.linalg.solve(bend, slope), -0.5, 0.5)
    return w


def test_few_jobs_find_the_optimum(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(4, 6, 4000)
    x[:3] = [400.0, -400.0, 0.0]        # beyond the cells
    y = (rng.random(4000) < 1 / (1 + np.exp(-np.clip(0.4 * x - 8, -50, 50)))).astype(int)
    rows = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "logit double, y int").cache()
    rows.count()
    spark.sparkContext.setJobGroup("calibration", "calibration")
    try:
        found = toxicity.calibrate(rows)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("calibration"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.allclose(found, plain(x, y), atol=1e-6)
    assert jobs <= 16


def test_no_rows_leave_the_scores(spark):
    assert toxicity.calibrate(spark.createDataFrame([], "logit double, y int")) == (1.0, 0.0)
