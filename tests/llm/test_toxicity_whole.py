"""Training and calibration of the toxicity model read every labelled row, not a sample of them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import toxicity


def test_words_outside_the_sample_are_learned(spark, monkeypatch):
    """One of two telling words stands only in rows that the sample never draws."""
    monkeypatch.setattr(toxicity, "SAMPLE_POSITIVE", 150)
    monkeypatch.setattr(toxicity, "SAMPLE_NEGATIVE", 300)
    draws = spark.range(4000).select("id", (F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30)) / (1 << 30)).alias("draw")).collect()
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    rows = []
    for i, draw in draws:
        w = rng.choices(vocabulary, k=rng.randrange(8, 30))
        if i % 4 == 0:
            w.insert(rng.randrange(len(w)), "zorkle" if draw < 0.4 else "quvtnmx")
        rows.append((i, " ".join(w), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in draws], "doc_id long, toxic int"))
    fresh = [(i, " ".join(rng.choices(vocabulary, k=20) + ["quvtnmx"] * (i % 2)), "en") for i in range(200)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(fresh, docs.schema), net).collect()}
    assert sum((got[i] >= 0.3) == bool(i % 2) for i, _, _ in fresh) >= 190


def test_calibration_and_thresholds_take_every_held_row(spark):
    """Sums in Spark against the same steps over all rows in one array."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 2, 3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.7 * x - 1)))).astype(int)
    langs = [("en", "de", None)[k % 3] for k in range(3000)]
    rows = spark.createDataFrame(list(zip(langs, y.tolist(), x.tolist())), "lang string, y int, logit double").repartition(5)
    scale, offset = toxicity.calibrate(rows)
    p = 1 / (1 + np.exp(-(scale * x + offset)))
    assert abs((x * (p - y)).sum() + 1e-2 * (scale - 1)) < 1e-4 and abs((p - y).sum() + 1e-2 * offset) < 1e-4
    got = toxicity.thresholds(toxicity.curve(rows, scale, offset))
    own = {k: np.array([lang == k for lang in langs]) for k in ("en", "de")}
    assert got == {k: pytest.approx(toxicity.best_threshold(p[m], y[m], np.ones(m.sum()))) for k, m in own.items()}


def test_every_training_row_is_visited_and_parts_are_averaged(monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity.Trainer, "step", lambda self, rows, rate: seen.append(rows))
    labels = np.array([1] * 5 + [0] * 70)
    toxicity.Trainer(pa.array(["a b"] * 75), labels).once()
    assert set(np.concatenate(seen)) == set(range(75))
    assert all((labels[rows] == 1).sum() == toxicity.BATCH // 2 for rows in seen)
    moved = pa.table({"chunk": [0, 0], "part": [1, 0], "steps": [np.int32([1, 0]).tobytes(), np.int32([3, 2]).tobytes()],
                      "delta": [np.float32([4, 4, 0, 0]).tobytes(), np.float32([0, 8, 6, 6]).tobytes()]})
    assert np.frombuffer(toxicity.averaged(moved).column("delta")[0].as_py(), np.float32).tolist() == [1, 7, 6, 6]
