"""Vocabularies are counted in blocks of texts, once, and two models are evaluated at the same time."""

import math
import threading
from collections import Counter

from pyspark.ml.linalg import SparseVector

from sievework.operators import ml

TEXTS = ["red red river runs", "the red river", "blue", "", None, "river runs deep red river runs", "a blue red river"]


def brute(texts, stop=()):
    tf, df = Counter(), Counter()
    for t in texts:
        w = [x for x in (t or "").split() if len(x) >= 2 and x not in stop]
        terms = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        tf.update(terms)
        df.update(set(terms))
    return tf, df


def test_features_are_fitted_by_one_count(spark, monkeypatch):
    def scanned(*_):
        raise AssertionError("document frequencies are known from the count of the vocabulary")

    monkeypatch.setattr(ml.IDF, "_fit", scanned)
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "resource_id long, title string").repartition(3)
    model = ml.fit_features(ml.text_stages("title", "features", min_df=2, vocab_size=6, stop_words=("the",)), rows)
    tf, df = brute(TEXTS, ("the",))
    want = sorted((t for t in tf if df[t] >= 2), key=lambda t: (-tf[t], t))[:6]
    vocabulary = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    assert vocabulary == want
    vectors = {r.resource_id: r.features for r in model.transform(rows).select("resource_id", "features").collect()}
    weight = {t: math.log((len(TEXTS) + 1) / (df[t] + 1)) + 1 for t in want}
    raw = {t: 2 * weight[t] if t == "red" else weight[t] for t in want if t in brute([TEXTS[0]])[0]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert isinstance(vectors[0], SparseVector) and len(vectors[0].indices) == len(raw)
    assert all(abs(vectors[0][want.index(t)] - v / norm) < 1e-12 for t, v in raw.items())


def test_vocabularies_of_several_frames(spark):
    frames = [TEXTS, TEXTS[:3], TEXTS[2:]]
    stages = [ml.text_stages("title", "features", kind="count", min_df=1, vocab_size=5) for _ in frames]
    made = []
    for own, texts in zip(stages, frames):
        df = spark.createDataFrame([(t,) for t in texts], "title string")
        for stage in own[:-1]:
            df = stage.transform(df)
        made.append(df.select("features_terms"))        # single words are taken from the terms
    models = ml.fit_vocabularies([s[-1] for s in stages], made)
    for model, texts in zip(models, frames):
        tf, df = brute(texts)
        assert model.vocabulary == sorted(tf, key=lambda t: (-tf[t], t))[:5]
        assert all(abs(v - math.log((len(texts) + 1) / (df[t] + 1)) - 1) < 1e-12 for t, v in zip(model.vocabulary, model.idf_of[1]))


def test_both_models_are_evaluated_at_once(monkeypatch):
    both = threading.Barrier(2, timeout=30)

    def evaluated(train, *_):
        both.wait()
        return train

    monkeypatch.setattr(ml, "evaluate_model", evaluated)
    monkeypatch.setattr(ml.metrics, "compare_metrics", lambda a, b: (a, b))
    assert ml.compare_models("first", "second", None) == ("first", "second")
