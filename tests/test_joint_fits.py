"""Feature stages fitted for many frames at once against fits of one frame."""

import pytest
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import functions as F

from sievework.operators import ml


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, int(i % 3 == 0), f"alpha w{i % 4} w{i % 7} w{i % 4}", "xyz"[i % 3]) for i in range(60)]
    return spark.createDataFrame(made, "resource_id long, bid int, title string, ca string")


def test_vocabularies_and_indexes_of_many_frames(rows):
    words = rows.withColumn("words", F.split("title", " "))
    frames = [words, words.where("resource_id < 25"), words.where("ca <> 'x'")]
    stages = [CountVectorizer(inputCol="words", outputCol="v", vocabSize=6, minDF=7.0, maxDF=40.0) for _ in frames]
    for stage, frame, model in zip(stages, frames, ml.fit_vocabularies(stages, frames)):
        want = stage.fit(frame)
        counts = frame.select(F.explode("words").alias("t")).groupBy("t").count()
        tf = {r["t"]: r["count"] for r in counts.collect()}
        assert sorted(tf[t] for t in model.vocabulary) == sorted(tf[t] for t in want.vocabulary)
        assert [tf[t] for t in model.vocabulary] == sorted((tf[t] for t in model.vocabulary), reverse=True)
        idf = ml.SmoothIdf("v", "w")._fit(model.transform(frame)).getScalingVec().toArray()
        assert abs(idf - model.idf_of[1]).max() < 1e-12
    stages = [StringIndexer(inputCol="ca", outputCol="i", handleInvalid="keep") for _ in frames]
    for stage, frame, model in zip(stages, frames, ml.fit_indexes(stages, frames)):
        assert list(model.labels) == list(stage.fit(frame).labels)


def test_texts_are_cut_up_once_for_all_folds(spark, rows):
    """The folds read finished words; only what the fits need is kept, and it scores as the whole pipeline does."""
    train = ml.trainer(lambda: [*ml.feature_stages(categories=("ca",), min_df=2), ml.classifier("logreg")])
    short, base = ml.prepared(train, rows)
    assert set(base.columns) == {"resource_id", "bid", "title_vector_terms", "ca_onehot_text"}
    assert len(short.stages()) < len(train.stages())
    a, b = ({r["resource_id"]: r["score"] for r in ml.score(t(f), f).collect()} for t, f in ((train, rows), (short, base)))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
