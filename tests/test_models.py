"""Splits, encoders and fits, by their properties."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sievework.operators import encode, metrics, ml
from sievework.plans import training


@pytest.fixture(scope="module")
def labelled(spark):
    """Titles that tell the class, now and then wrongly; one authority holds a third of the rows."""
    i = F.col("id")
    positive = (i % 5 == 0)
    word = F.when(positive & (i % 35 != 0), "software support").when(i % 11 == 0, "software support").otherwise("road works")
    return spark.range(300).select(
        i.alias("resource_id"), F.concat(word, F.lit(" lot "), (i % 7).cast("string"), F.lit("x")).alias("title"),
        F.when(i % 3 == 0, "big").otherwise(F.concat(F.lit("ca"), (i % 9).cast("string"))).alias("ca"),
        F.lit("open").alias("procedure"), positive.cast("int").alias("bid"),
    ).cache()


STAGES = lambda: [*ml.feature_stages(min_df=2), ml.classifier("logreg")]
SVM = lambda: [*ml.feature_stages(min_df=2), ml.classifier("svm")]


def test_folds_cover_and_balance(labelled):
    folds = encode.stratified_folds(labelled, "resource_id", "bid", 7)
    assert folds.count() == 300 and folds.select("resource_id").distinct().count() == 300
    for r in folds.groupBy("bid").pivot("fold", list(range(7))).count().collect():
        sizes = [r[str(k)] for k in range(7)]
        assert max(sizes) - min(sizes) <= 1
    again = encode.stratified_folds(labelled.repartition(5), "resource_id", "bid", 7)
    assert folds.join(again, ["resource_id", "fold"], "left_semi").count() == 300


@pytest.mark.parametrize("bits,most", [(16, 1 << 20), (2, 3), (16, 0)])
def test_cuts_are_exact_ranks(spark, bits, most):
    rows = [(k % 37 if k < 100 else k, (None, "a", "b")[k % 3] if k > 20 else "c") for k in range(400)]
    df = spark.createDataFrame(rows, "key long, label string")
    hashed = df.select("label", F.xxhash64("key", F.lit(42)).alias("h"), "key").collect()
    ranks = lambda n: [F.ceil(n / 3), F.ceil(n * 2 / 3), n]
    got = {r["label"]: [tuple(c) for c in r["cuts"]] for r in encode.rank_cuts(df, "key", "label", ranks, bits=bits, most=most).collect()}
    for label in (None, "a", "b", "c"):
        own = sorted((r["h"], r["key"]) for r in hashed if r["label"] == label)
        n = len(own)
        assert got[label] == [own[-(-n // 3)], own[-(-2 * n // 3)]]


def test_repeated_keys_keep_their_number(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (3, 1), (None, 1), (4, None)], "key long, label int")
    for split in (encode.stratified_folds(df, "key", "label", 2), encode.stratified_split(df, "key", "label", 0.5)):
        assert sorted((str(r["key"]), str(r["label"])) for r in split.collect()) == sorted((str(a), str(b)) for a, b in df.collect())
    assert encode.stratified_folds(df.limit(0), "key", "label").collect() == []


def test_folds_read_keys_only(labelled):
    """The frame itself passes no exchange."""
    folds = encode.stratified_folds(labelled, "resource_id", "bid", 5)
    assert "Exchange hashpartitioning" not in folds._jdf.queryExecution().executedPlan().toString()


def test_split_shares(labelled):
    got = {(r["bid"], r["is_test"]): r["n"] for r in encode.stratified_split(labelled, "resource_id", "bid").groupBy("bid", "is_test").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(0, True): 48, (0, False): 192, (1, True): 12, (1, False): 48}


def test_weights_balance_the_classes(labelled):
    sums = [r["s"] for r in encode.class_weights(labelled).groupBy("bid").agg(F.sum("weight").alias("s")).collect()]
    assert all(abs(s - 150) < 1e-9 for s in sums)


def test_label_codes(spark, labelled):
    codes = encode.label_codes(labelled, "ca")
    assert {r["value"]: r["code"] for r in codes.collect()}["big"] == 0
    other = spark.createDataFrame([("nobody",), ("big",)], "ca string")
    assert sorted(r["ca_encoded"] for r in encode.label_encode(other, "ca", codes, unseen=-1).collect()) == [-1, 0]
    # Numbered across ranges without gaps, in alphabetical order.
    many = spark.range(5000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("ca"))
    assert all(int(r["value"][1:]) == r["code"] for r in encode.label_codes(many.union(many), "ca").collect())


def test_rare_values_become_null(labelled):
    got = encode.rare_to_null(labelled, "ca", 50).groupBy("ca").count().collect()
    assert {r["ca"] for r in got} == {"big", None} and sum(r["count"] for r in got) == 300


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(float(v), 3.0, Vectors.dense([float(v)])) for v in (1, 2, 3, 4)], ["x", "c", "v"])
    got = encode.scale_features(df, ["x", "c"]).orderBy("x").collect()
    assert abs(got[0]["x"] + 1.5 / math.sqrt(1.25)) < 1e-12 and got[0]["c"] == 0.0
    scaled = ml.PopulationScaler("v", "out").fit(df).transform(df).select(vector_to_array("out")[0].alias("o")).collect()
    assert abs(min(r["o"] for r in scaled) + 1.5 / math.sqrt(1.25)) < 1e-9


def test_accents_and_tokens(spark):
    df = spark.createDataFrame([("Été à l'École, x 12 ab1",)], "t string")
    row = df.select(encode.strip_accents("t").alias("a"), encode.tokenize(encode.strip_accents("t"), ("ete",)).alias("b"),
                    encode.analyze(F.col("t")).alias("c")).first()
    assert row["a"] == "Ete a l'Ecole, x 12 ab1" and row["b"] == ["ecole"]
    assert row["c"] == ["été", "école", "12", "ab1", "été école", "école 12", "12 ab1"]


def test_tfidf_rows_have_unit_length(labelled):
    vectors = ml.fit(ml.text_stages("title", "features", min_df=2), labelled).transform(labelled)
    squares = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x * x)
    assert all(abs(r["s"] - 1) < 1e-9 for r in vectors.select(squares.alias("s")).collect())


def test_out_of_fold_scores(labelled):
    oof = ml.oof_predictions(ml.trainer(STAGES), labelled, folds=3).cache()
    assert oof.count() == 300 and oof.select("resource_id").distinct().count() == 300
    assert oof.where("score < 0 OR score > 1").count() == 0
    assert metrics.roc_auc(ml.as_scored(oof)).first()["auc"] > 0.8


def test_calibration_keeps_the_order(labelled):
    model = ml.calibrate(SVM, labelled)
    assert len(model.models) == 3 and all(a > 0 for a, _ in model.sigmoids)
    scores = model.score(labelled)
    assert scores.count() == 300 and scores.where("score <= 0 OR score >= 1").count() == 0


def test_sigmoids_are_optimal(spark):
    rng = np.random.default_rng(0)
    rows = [(m, float(x), int(rng.random() < 1 / (1 + math.exp(-(2 * x - m))))) for m in range(3) for x in rng.normal(size=200)]
    for m, (a, b) in enumerate(ml.sigmoids(spark.createDataFrame(rows, "model int, score double, bid int"), 3)):
        x, y = np.array([r[1] for r in rows if r[0] == m]), np.array([r[2] for r in rows if r[0] == m])
        t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        slope = 1 / (1 + np.exp(-(a * x + b))) - t
        assert abs((slope * x).sum()) < 1e-6 and abs(slope.sum()) < 1e-6 and a > 0


def test_calibrated_scores_keep_repeated_keys(spark, labelled):
    model = ml.calibrate(SVM, labelled)
    twice = labelled.limit(5).union(labelled.limit(5))
    assert model.score(twice).count() == 10


def test_tree_on_projected_titles(spark, labelled, tmp_path):
    df = labelled.withColumn("title_length", F.length("title").cast("double"))
    model = ml.fit(ml.projected_tree_stages(dimensions=4), df)
    ml.save_model(spark, model, str(tmp_path / "tree"), 0.5, ["title"])
    loaded = ml.load_model(spark, str(tmp_path / "tree")).model
    a, b = ({r["resource_id"]: r["score"] for r in ml.score(m, df).collect()} for m in (model, loaded))
    assert a == b and metrics.roc_auc(ml.score(model, df).select("score", F.col("bid").alias("y"))).first()["auc"] > 0.8


def test_saved_model_scores_the_same(spark, labelled, tmp_path):
    model = ml.fit(STAGES(), labelled)
    ml.save_model(spark, model, str(tmp_path / "m"), 0.3, ["title"])
    loaded = ml.load_model(spark, str(tmp_path / "m"))
    assert (loaded.threshold, loaded.names) == (0.3, ["title"])
    a = {r["resource_id"]: r["score"] for r in ml.score(model, labelled).collect()}
    b = {r["resource_id"]: r["score"] for r in ml.score(loaded.model, labelled).collect()}
    assert a == b


def test_models_score_in_a_session_that_observes(spark, labelled):
    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10}
    for stages in (STAGES(), SVM(), [*ml.feature_stages(min_df=2), ml.classifier("forest", trees=3, depth=2)]):
        assert len(ml.score(ml.fit(stages, labelled), labelled).collect()) == 300


def test_unseen_categories_do_not_fail(spark, labelled):
    model = ml.fit(STAGES(), labelled)
    strange = spark.createDataFrame([(1, "words never seen", "unknown ca", None)], "resource_id long, title string, ca string, procedure string")
    assert ml.score_batch(model, strange, 0.5).first()["predicted"] in (0, 1)


def test_ablation_and_coefficients(labelled):
    model = ml.fit(STAGES(), labelled)
    rows = {r["variant"]: r for r in ml.block_ablation(model, labelled, {"no text": ["title_vector"], "nothing": []}).collect()}
    assert rows["full"]["drop"] == rows["nothing"]["drop"] == 0 and rows["no text"]["drop"] > 0
    scored = ml.score(model, labelled)
    right = scored.where((F.col("score") >= 0.5) == (F.col("bid") == 1)).count() / 300
    assert abs(rows["full"]["accuracy"] - right) < 1e-12
    margins, blocks = ml.block_margins(model, labelled)
    total = {r["resource_id"]: sum(r["parts"]) + model.stages[-1].intercept for r in margins.collect()}
    assert all(abs(1 / (1 + math.exp(-total[r["resource_id"]])) - r["score"]) < 1e-9 for r in scored.collect()) and len(blocks) == 3
    report = ml.coef_report(model, labelled, k=3).collect()
    assert {r["block"] for r in report if r["kind"] == "norm"} == {"title_vector", "ca_onehot", "procedure_onehot"}
    assert {"software", "support", "software support"} & {r["feature"] for r in report if r["kind"] == "positive"}


def test_train_and_choose(labelled):
    model, threshold, rows = training.train_and_choose(ml.trainer(STAGES), labelled, folds=3, min_recall=0.8)
    values = {r["metric"]: r["value"] for r in rows.collect()}
    assert values["recall"] >= 0.8 and values["threshold"] == threshold


def test_projection(spark):
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 30)) * (rng.random((60, 30)) < 0.4)
    rows = [(i, Vectors.sparse(30, [(j, v) for j, v in enumerate(r) if v]) if i % 2 else Vectors.dense(r)) for i, r in enumerate(dense)]
    df = spark.createDataFrame(rows, ["resource_id", "features"])
    out, singular = ml.svd_project(df, "features", 3)
    _, want, axes = np.linalg.svd(dense)
    assert np.allclose(singular, want[:3], rtol=1e-4)
    got = np.array([r["projected"] for r in out.orderBy("resource_id").collect()])
    assert np.allclose(np.abs(got), np.abs(dense @ axes[:3].T), atol=1e-2 * want[0])
    model = ml.LatentProjection("features", "p", 3).fit(df)
    assert np.allclose(model.pc.toArray().T @ model.pc.toArray(), np.eye(3), atol=1e-9)
