"""Text classifiers on ``pyspark.ml``: feature stages, fits, calibration, evaluation.

A labelled frame has ``resource_id``, ``bid`` (0/1) and the columns the stages read. Frames that
many fits share are written once (:func:`cut_lineage`), and only metric rows reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizer, CountVectorizerModel, ElementwiseProduct, HashingTF, IDF, NGram, Normalizer, OneHotEncoder,
    RegexTokenizer, SQLTransformer, StandardScaler, StopWordsRemover, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework import fixed_values as fv
from sievework.operators import metrics
from sievework.operators.encode import _term_counts, accents, class_weights, stratified_folds, stratified_split
from sievework.operators.latent import LatentProjection
from sievework.operators.linear import LOGISTIC, SQUARED_HINGE, NewtonClassifier, lists, sparse_rows
from sievework.session import cut_lineage

KEY, LABEL = "resource_id", "bid"


# -- stages ---------------------------------------------------------------------------------------

class SmoothIdf(Estimator):
    """Scales term counts by ln((n + 1) / (df + 1)) + 1; fits to an ``ElementwiseProduct``."""

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset):
        idf = IDF(inputCol=self.input_col, outputCol="_idf").fit(dataset).idf.toArray()
        return ElementwiseProduct(
            scalingVec=Vectors.dense(idf + 1.0), inputCol=self.input_col, outputCol=self.output_col
        )


class PopulationScaler(Estimator):
    """Standard scaling with the population deviation; fits to a pair of built-in transformers."""

    def __init__(self, input_col: str, output_col: str, with_mean: bool = True):
        super().__init__()
        self.input_col, self.output_col, self.with_mean = input_col, output_col, with_mean

    def _fit(self, dataset):
        middle = f"{self.output_col}_sample"
        scaler = StandardScaler(
            withMean=self.with_mean, withStd=True, inputCol=self.input_col, outputCol=middle
        ).fit(dataset)
        n = dataset.count()
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
        stretch = ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * len(scaler.std)), inputCol=middle, outputCol=self.output_col
        )
        return PipelineModel([scaler, stretch])


def _sql(expression: str, output: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {expression} AS {output} FROM __THIS__")


def text_stages(
    column: str, output: str, kind: str = "tfidf", vocab_size: int = 40_000, min_df: int = 3, max_df: float = 1.0,
    bigrams: bool = True, stop_words: Sequence[str] = (), letters_only: bool = False, hash_size: int = 1 << 18,
) -> list:
    """Text to a sparse vector: ``tfidf`` (M05), ``count`` (M07) or ``hash``."""
    source, target = accents()
    p = f"{output}_"
    pattern = r"(?U)\b[a-z][a-z]+\b" if letters_only else r"(?U)\b\w\w+\b"
    stages: list = [
        _sql(f"translate(coalesce({column}, ''), '{source}', '{target}')", p + "plain"),
        RegexTokenizer(inputCol=p + "plain", outputCol=p + "words", pattern=pattern, gaps=False, toLowercase=True),
    ]
    words = p + "words"
    if stop_words:
        stages.append(StopWordsRemover(inputCol=words, outputCol=p + "kept", stopWords=list(stop_words)))
        words = p + "kept"
    single = words
    if bigrams:
        stages += [
            NGram(n=2, inputCol=words, outputCol=p + "pairs"), _sql(f"concat({words}, {p}pairs)", p + "terms"),
        ]
        words = p + "terms"
    if kind == "hash":
        return stages + [
            HashingTF(inputCol=words, outputCol=p + "hashed", numFeatures=hash_size),
            Normalizer(inputCol=p + "hashed", outputCol=output, p=2.0),
        ]
    counts = output if kind == "count" else p + "counts"
    vectorizer = CountVectorizer(
        inputCol=words, outputCol=counts, vocabSize=vocab_size, minDF=float(min_df),
        maxDF=float(max_df) if max_df < 1.0 else float(2**62),  # from 1 on the bound is a count
    )
    vectorizer.words_of = (single, bigrams)     # the column of single words, and whether their pairs follow them
    stages.append(vectorizer)
    if kind == "tfidf":
        stages += [SmoothIdf(counts, p + "weighted"), Normalizer(inputCol=p + "weighted", outputCol=output, p=2.0)]
    return stages


def category_stages(column: str, output: str) -> list:
    """One-hot of a category; an unseen value falls into a place of its own."""
    return [
        _sql(f"coalesce({column}, '')", f"{output}_text"),
        StringIndexer(inputCol=f"{output}_text", outputCol=f"{output}_index", handleInvalid="keep"),
        OneHotEncoder(inputCol=f"{output}_index", outputCol=output, handleInvalid="keep", dropLast=False),
    ]


def feature_stages(
    text: Sequence[str] = ("title",), categories: Sequence[str] = ("ca", "procedure"), numbers: Sequence[str] = (),
    codes: str | None = None, **text_options,
) -> list:
    """Text, category, number and code blocks side by side in ``features``.

    ``vocab_size`` is one size or one for each text column.
    """
    stages, blocks = [], []
    for column in text:
        size = text_options.get("vocab_size", 40_000)
        own = text_options | {"vocab_size": size[column] if isinstance(size, Mapping) else size}
        stages += text_stages(column, f"{column}_vector", **own)
        blocks.append(f"{column}_vector")
    for column in categories:
        stages += category_stages(column, f"{column}_onehot")
        blocks.append(f"{column}_onehot")
    if codes:
        stages.append(CountVectorizer(inputCol=codes, outputCol="codes_vector", binary=True, minDF=1.0))
        blocks.append("codes_vector")
    if numbers:
        stages += [
            VectorAssembler(inputCols=list(numbers), outputCol="numbers_raw"),
            PopulationScaler("numbers_raw", "numbers_vector"),
        ]
        blocks.append("numbers_vector")
    return [*stages, VectorAssembler(inputCols=blocks, outputCol="features")]


def projected_tree_stages(dimensions: int = 120, vocab_size: int = 3000, stop_words: Sequence[str] = (), categories: Sequence[str] = ("ca", "procedure")) -> list:
    """A tree on the title's latent dimensions, ``title_length`` and one-hot categories."""
    stages = [
        *text_stages("title", "title_vector", vocab_size=vocab_size, min_df=1, stop_words=stop_words),
        LatentProjection("title_vector", "title_latent", dimensions),
    ]
    for column in categories:
        stages += category_stages(column, f"{column}_onehot")
    blocks = ["title_latent", "title_length", *(f"{c}_onehot" for c in categories)]
    return [*stages, VectorAssembler(inputCols=blocks, outputCol="features"), classifier("tree")]


def classifier(kind: str, features: str = "features", **options):
    """The classifiers in use, weighted by ``weight``."""
    common = {"featuresCol": features, "labelCol": LABEL, "weightCol": "weight"}
    if kind == "logreg":
        return NewtonClassifier(LOGISTIC, options.get("c", 1.0), features, LABEL)
    if kind == "svm":
        return NewtonClassifier(SQUARED_HINGE, options.get("c", 1.0), features, LABEL)
    if kind == "forest":
        return RandomForestClassifier(
            **common, numTrees=options.get("trees", 50), maxDepth=options.get("depth", 8),
            minInstancesPerNode=options.get("leaf", 1), seed=options.get("seed", 42),
        )
    if kind == "tree":
        return DecisionTreeClassifier(
            **common, maxDepth=options.get("depth", 15), minInstancesPerNode=options.get("leaf", 5),
            seed=options.get("seed", 42),
        )
    raise ValueError(f"unknown classifier {kind}")


class ArrayToVector(Transformer):
    """A dense array column, such as a stored text vector, as an ML vector."""

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _transform(self, dataset):
        return dataset.withColumn(self.output_col, array_to_vector(F.col(self.input_col).cast("array<double>")))


def dense_stages(column: str = "embedding") -> list:
    """Stored text vectors, scaled."""
    return [ArrayToVector(column, f"{column}_vector"), PopulationScaler(f"{column}_vector", "features")]


# -- fits and scores ------------------------------------------------------------------------------

def model_score(df: DataFrame) -> Column:
    """Probability of the positive class, or the margin of a model without probabilities."""
    if "probability" in df.columns:
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]


def without_summary(model):
    """``model`` without its training summary.

    The summary holds the session, which no task can receive once the session has observed a metric.
    """
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit(stages: Sequence, labelled: DataFrame) -> PipelineModel:
    if stages and isinstance(stages[-1], NewtonClassifier):
        return fit_many(lambda: stages, [labelled])[0]
    return without_summary(Pipeline(stages=list(stages)).fit(class_weights(labelled, LABEL)))


def fit_many(stages: Callable[[], Sequence], frames: Sequence[DataFrame], parallelism: int = 8) -> list[PipelineModel]:
    """A model for each frame; the stages are made anew for each.

    Each feature stage is fitted for all frames together where one job can do it (:func:`fit_stage`), and
    linear classifiers are fitted in the same scans.
    """
    weighted = [class_weights(f, LABEL) for f in frames]
    each = [list(stages()) for _ in frames]
    last = each[0][-1]
    if not isinstance(last, NewtonClassifier):
        return _each([lambda s=s, f=f: without_summary(Pipeline(stages=s).fit(f)) for s, f in zip(each, weighted)], parallelism)
    fitted: list[list] = [[] for _ in frames]
    for same in zip(*[s[:-1] for s in each]):
        models = fit_stage(same, weighted, fitted, parallelism) if isinstance(same[0], Estimator) else same
        for own, model in zip(fitted, models):
            own.append(model)
        weighted = _each([lambda m=m, f=f: m.transform(f) for m, f in zip(models, weighted)], parallelism)
    found = last.fit_many(weighted)
    return [PipelineModel([*own, c]) for own, c in zip(fitted, found)]


def fit_features(stages: Sequence, df: DataFrame) -> PipelineModel:
    """Feature stages fitted to a frame. One count of the terms gives a vocabulary and its document frequencies."""
    fitted: list = []
    for stage in stages:
        fitted.append(fit_stage([stage], [df], [fitted])[0] if isinstance(stage, Estimator) else stage)
        df = fitted[-1].transform(df)
    return PipelineModel(fitted)


def fit_stage(same: Sequence[Estimator], frames: Sequence[DataFrame], before: Sequence[Sequence], parallelism: int = 8) -> list:
    """The models of a stage for each frame; ``before`` holds the models of the stages before it."""
    stage = same[0]
    if isinstance(stage, CountVectorizer):
        return fit_vocabularies(same, frames)
    if isinstance(stage, StringIndexer) and stage.isSet("inputCol") and stage.getStringOrderType() == "frequencyDesc":
        return fit_indexes(same, frames)
    if isinstance(stage, SmoothIdf):
        counted = [next((m for m in reversed(own) if getattr(m, "idf_of", (None,))[0] == stage.input_col), None) for own in before]
        if None not in counted:
            return [
                ElementwiseProduct(scalingVec=Vectors.dense(m.idf_of[1]), inputCol=stage.input_col, outputCol=stage.output_col)
                for m in counted
            ]
    return _each([lambda s=s, f=f: s.fit(f) for s, f in zip(same, frames)], parallelism)


def _marked(frames: Sequence[DataFrame], *columns) -> DataFrame:
    """``columns`` of all frames in one, with the number of the frame as ``model``."""
    return reduce(DataFrame.unionByName, [f.select(F.lit(k).alias("model"), *columns) for k, f in enumerate(frames)])


def fit_vocabularies(same: Sequence[CountVectorizer], frames: Sequence[DataFrame]) -> list[CountVectorizerModel]:
    """The vocabulary of each frame, most frequent terms first, and their smooth inverse document frequencies.

    One aggregation adds up occurrences and documents of the terms of all frames. Tasks count the words of a
    text column and their pairs in blocks of texts (:func:`_term_counts`); other terms go one by one: sorted, they
    tell the first occurrence in a document from the others, so documents need no key.
    """
    terms = F.col(same[0].getInputCol())
    sizes = {r["model"]: r["n"] for r in _marked(frames).groupBy("model").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [sizes.get(k, 0) for k in range(len(frames))]
    if hasattr(same[0], "words_of"):
        column, pairs = same[0].words_of
        words = F.slice(terms, 1, ((F.size(terms) + 1) / 2).cast("int")) if pairs else terms    # n words and n - 1 pairs
        parts = [f.select((F.col(column) if column in f.columns else words).alias("words")) for f in frames]
        blocks = [p.mapInArrow(partial(_term_counts, bigrams=pairs), "term string, tf long, df long") for p in parts]
        counted = _marked(blocks, "term", "tf", "df").groupBy("model", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    else:
        rows = _marked(frames, F.array_sort(terms).alias("terms"))
        first = F.transform("terms", lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get("terms", i - 1) != t)).cast("int").alias("first")))
        counted = rows.select("model", F.explode(first).alias("t")).groupBy("model", "t.term").agg(F.count(F.lit(1)).alias("tf"), F.sum("t.first").alias("df"))
    bound = lambda v, n: v if v >= 1.0 else v * n
    limits = F.array(*[F.struct(F.lit(bound(s.getMinDF(), n)).cast("double").alias("low"), F.lit(bound(s.getMaxDF(), n)).cast("double").alias("high"), F.lit(s.getVocabSize()).alias("size")) for s, n in zip(same, sizes)])
    kept = counted.withColumn("_own", F.get(limits, F.col("model"))).where("df >= _own.low AND df <= _own.high")
    if len(frames) == 1:    # the most frequent terms of every task, then of these; a window would sort all terms in one
        top = kept.withColumn("place", -F.col("tf")).orderBy("place", "term").limit(same[0].getVocabSize())
    else:
        place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("tf"), "term"))
        top = kept.withColumn("place", place).where(F.col("place") <= max(s.getVocabSize() for s in same)).where("place <= _own.size")
    terms: list[list] = [[] for _ in frames]
    for r in top.select("model", "place", "term", "df").toLocalIterator():
        terms[r["model"]].append((r["place"], r["term"], r["df"]))
    out = []
    for stage, n, found in zip(same, sizes, terms):
        found.sort()
        if not found:
            raise ValueError("no term of the texts is within the bounds of the vocabulary")
        model = vocabulary_model([t for _, t, _ in found], stage)
        model.idf_of = (stage.getOutputCol(), np.log((n + 1) / (np.array([d for *_, d in found]) + 1.0)) + 1.0)
        out.append(model)
    return out


def vocabulary_model(terms: list[str], stage: CountVectorizer) -> CountVectorizerModel:
    """The model of ``stage`` with these terms; they go over as one text, not one call for each."""
    if "" in terms or any("\x00" in t for t in terms):
        return CountVectorizerModel.from_vocabulary(terms, stage.getInputCol(), stage.getOutputCol(), stage.getMinTF(), stage.getBinary())
    array = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile("\x00").split("\x00".join(terms))
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    model.setInputCol(stage.getInputCol()).setOutputCol(stage.getOutputCol()).setMinTF(stage.getMinTF()).setBinary(stage.getBinary())
    return model._set(vocabSize=len(terms))


def fit_indexes(same: Sequence[StringIndexer], frames: Sequence[DataFrame]) -> list:
    """The categories of each frame, most frequent first and ties by name, counted in one aggregation."""
    column = same[0].getInputCol()
    counted = _marked(frames, F.col(column).cast("string").alias("value")).where("value IS NOT NULL").groupBy("model", "value").agg(F.count(F.lit(1)).alias("n"))
    labels: list[list] = [[] for _ in frames]
    for r in counted.collect():
        labels[r["model"]].append((-r["n"], r["value"]))
    return [
        StringIndexerModel.from_labels([v for _, v in sorted(own)], column, s.getOutputCol(), s.getHandleInvalid()) if own else s.fit(f)
        for s, f, own in zip(same, frames, labels)
    ]


def prepared(train: Trainer, rows: DataFrame) -> tuple[Trainer, DataFrame]:
    """``train`` without the stages that learn nothing and need no fitted one, and ``rows`` with what they make, written once.

    Folds and sizes then share the words of a text instead of cutting it up for each fit and score.
    """
    done, kept = [], set(rows.columns) & {KEY, LABEL, "weight", "fold", "_u"}
    for stage in train.stages():
        made = None
        if not isinstance(stage, Estimator):
            try:
                made = stage.transform(rows)
            except (AnalysisException, IllegalArgumentException):  # its input is yet to be fitted
                pass
        done.append(made is not None)
        rows = rows if made is None else made
    rest = lambda: [s for s, d in zip(train.stages(), done) if not d]
    for stage in rest():
        kept |= set(rows.columns) if isinstance(stage, SQLTransformer) else set(_inputs(stage)) & set(rows.columns)
    return Trainer(rest, train.calibrated), cut_lineage(rows.select(*[c for c in rows.columns if c in kept]))


def _inputs(stage) -> list[str]:
    """The columns that a stage names as its input."""
    own = [getattr(stage, a) for a in ("input_col", "features", "label", "weight") if isinstance(getattr(stage, a, None), str)]
    for name in ("inputCol", "inputCols", "featuresCol"):
        if stage.hasParam(name) and stage.isDefined(name):
            value = stage.getOrDefault(name)
            own += [value] if isinstance(value, str) else list(value)
    return own


def score(model, df: DataFrame) -> DataFrame:
    """(resource_id, bid if known, score)."""
    if isinstance(model, CalibratedModel):
        return model.score(df)
    scored = model.transform(df)
    known = [LABEL] if LABEL in df.columns else []
    return scored.select(KEY, *known, model_score(scored).alias("score"))


def score_batch(model, df: DataFrame, threshold: float = fv.REVIEW_THRESHOLD) -> DataFrame:
    """Probability and thresholded label of each row."""
    return score(model, df).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@dataclass
class CalibratedModel:
    """Mean of the sigmoids of several margin models."""

    models: list[PipelineModel]
    sigmoids: list[tuple[float, float]]

    def score(self, df: DataFrame) -> DataFrame:
        """All models pass over the same rows, each with a column of its own."""
        own, done = [F.col(f"`{c}`") for c in df.columns], []
        for i, (model, (a, b)) in enumerate(zip(self.models, self.sigmoids)):
            raw = model.transform(df)
            p = 1.0 / (1.0 + F.exp(-(F.lit(a) * model_score(raw) + F.lit(b))))
            df = raw.select(*own, *done, p.alias(f"_p{i}"))
            done.append(F.col(f"_p{i}"))
        known = [LABEL] if LABEL in df.columns else []
        return df.select(KEY, *known, (reduce(lambda x, y: x + y, done) / len(done)).alias("score"))


def sigmoids(margins: DataFrame, n: int, steps: int = 30) -> list[tuple[float, float]]:
    """Slope and offset of the logistic curve over (model, score, bid) for each of ``n`` models.

    Newton's method on smoothed targets; a step is one aggregation of five sums a model, for all models at once.
    """
    sizes = {r["model"]: r for r in margins.groupBy("model").agg(F.count_if(F.col(LABEL) == 1).alias("p"), F.count_if(F.col(LABEL) == 0).alias("q")).collect()}
    p, q = (np.array([float(sizes[i][c]) if i in sizes else 0.0 for i in range(n)]) for c in ("p", "q"))
    high, low = (p + 1) / (p + 2), 1 / (q + 2)
    a, b = np.zeros(n), np.log((p + 1) / (q + 1))
    pick = lambda values: F.get(F.array(*(F.lit(float(v)) for v in values)), F.col("model"))

    def sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, z = F.col("score"), pick(a) * F.col("score") + pick(b)
        t = F.when(F.col(LABEL) == 1, pick(high)).otherwise(pick(low))
        s = 1.0 / (1.0 + F.exp(-z))
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z
        parts = [loss, (s - t) * x, s - t, s * (1 - s) * x * x, s * (1 - s) * x, s * (1 - s)]
        out = np.zeros((n, len(parts)))
        for r in margins.groupBy("model").agg(*[F.sum(e).alias(f"s{k}") for k, e in enumerate(parts)]).collect():
            out[r["model"]] = [r[f"s{k}"] for k in range(len(parts))]
        return out

    now, size = sums(a, b), np.ones(n)
    for _ in range(steps):
        _, ga, gb, haa, hab, hbb = now.T
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab + 1e-300
        da, db = (ga * hbb - gb * hab) / det, (gb * haa - ga * hab) / det
        if np.max(np.abs(ga) + np.abs(gb)) < 1e-8:
            break
        trial = sums(a - size * da, b - size * db)
        better = trial[:, 0] <= now[:, 0] + 1e-12
        a, b = np.where(better, a - size * da, a), np.where(better, b - size * db, b)
        now, size = np.where(better[:, None], trial, now), np.where(better, 1.0, size / 2)
        if not better.any() and size.max() < 1e-6:
            break
    return list(zip(a.tolist(), b.tolist()))


def calibrate_many(stages: Callable[[], Sequence], frames: Sequence[DataFrame], folds: int = 3, seed: int = 42) -> list[CalibratedModel]:
    """A calibrated model for each frame; the fits of all folds of all frames share their scans."""
    parts = _each([lambda f=f: cut_lineage(stratified_folds(f, KEY, LABEL, folds, seed)) for f in frames], 8)
    models = fit_many(stages, [p.where(F.col("fold") != i) for p in parts for i in range(folds)])
    held = [score(models[k * folds + i], p.where(F.col("fold") == i)).select(F.lit(k * folds + i).alias("model"), "score", LABEL) for k, p in enumerate(parts) for i in range(folds)]
    curves = sigmoids(cut_lineage(reduce(DataFrame.unionByName, held)), len(models))
    return [CalibratedModel(models[k:k + folds], curves[k:k + folds]) for k in range(0, len(models), folds)]


def calibrate(stages: Sequence | Callable[[], Sequence], labelled: DataFrame, folds: int = 3, seed: int = 42) -> CalibratedModel:
    """Sigmoid calibration: each fold's model is calibrated on the part it has not seen."""
    return calibrate_many(stages if callable(stages) else lambda: stages, [labelled], folds, seed)[0]


def _each(jobs: Sequence[Callable], parallelism: int) -> list:
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


@dataclass
class Trainer:
    """From labelled frames to models, as many as there are frames in the scans of one."""

    stages: Callable[[], Sequence]
    calibrated: bool = False

    def many(self, frames: Sequence[DataFrame]) -> list:
        return calibrate_many(self.stages, frames) if self.calibrated else fit_many(self.stages, frames)

    def __call__(self, labelled: DataFrame):
        return self.many([labelled])[0]


def trainer(stages: Callable[[], Sequence], calibrated: bool = False) -> Trainer:
    return Trainer(stages, calibrated)


def oof_predictions(train: Trainer, labelled: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """Every row scored by the model that has not seen it."""
    train, parts = prepared(train, stratified_folds(labelled, KEY, LABEL, folds, seed))
    models = train.many([parts.where(F.col("fold") != i).drop("fold") for i in range(folds)])
    frames = [score(m, parts.where(F.col("fold") == i)).withColumn("fold", F.lit(i)) for i, m in enumerate(models)]
    return reduce(DataFrame.unionByName, frames)


def as_scored(oof: DataFrame) -> DataFrame:
    return oof.select("score", F.col(LABEL).alias("y"))


def fold_metrics(oof: DataFrame, threshold: float, by: Sequence[str] = ("fold",)) -> DataFrame:
    """Accuracy and F1 per fold."""
    p, y = F.col("score") >= threshold, F.col(LABEL) == 1
    counted = oof.groupBy(*by).agg(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in metrics.COUNTS)
    return counted.select(
        *by, metrics.ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), metrics.ratio(2 * tp, 2 * tp + fp + fn).alias("f1")
    )


def cv_scores(train: Trainer, labelled: DataFrame, folds: int = 5, threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """Mean and deviation of the fold metrics."""
    per_fold = fold_metrics(oof_predictions(train, labelled, folds, seed), threshold)
    rows = per_fold.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "f1")
    ])).alias("r")).select("r.*")
    return rows.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds"))


def learning_curve(
    train: Trainer, labelled: DataFrame, sizes: Sequence[float], folds: int = 5, threshold: float = 0.5, seed: int = 42,
) -> DataFrame:
    """Train and test F1 for growing shares of the training part, nested by hash."""
    train, parts = prepared(train, stratified_folds(labelled, KEY, LABEL, folds, seed).withColumn(
        "_u", (F.pmod(F.xxhash64(F.col(KEY), F.lit(seed + 1)), F.lit(1_000_000)) + 1) / F.lit(1_000_000.0)
    ))
    jobs = [(size, i) for size in sizes for i in range(folds)]
    used = [parts.where((F.col("fold") != i) & (F.col("_u") <= size)).drop("fold", "_u") for size, i in jobs]
    scored = []
    for (size, i), frame, model in zip(jobs, used, train.many(used)):
        for name, rows in (("train", frame), ("test", parts.where(F.col("fold") == i).drop("fold", "_u"))):
            scored.append(score(model, rows).select(F.lit(float(size)).alias("size"), F.lit(i).alias("fold"), F.lit(name).alias("part"), "score", LABEL))
    each = fold_metrics(reduce(DataFrame.unionByName, scored), threshold, ("size", "part", "fold"))
    return each.groupBy("size", "part").agg(F.avg("f1").alias("f1"), F.stddev_pop("f1").alias("f1_std"), F.avg("accuracy").alias("accuracy"))


def evaluate_model(train: Trainer, labelled: DataFrame, recall: float = 0.85, folds: int = 5) -> DataFrame:
    """(metric, value) rows at the threshold that holds the recall, from out-of-fold scores."""
    scored = cut_lineage(as_scored(oof_predictions(train, labelled, folds)))
    threshold = metrics.threshold_for_recall(scored, [recall]).first()["threshold"]
    return metrics.metric_rows(scored, threshold)


def compare_models(first: Trainer, second: Trainer, labelled: DataFrame, recall: float = 0.85, folds: int = 5) -> DataFrame:
    """Two models side by side at the same recall target.

    The fits of either model are many small jobs, so both are evaluated at the same time.
    """
    return metrics.compare_metrics(*_each([lambda t=t: evaluate_model(t, labelled, recall, folds) for t in (first, second)], 2))


def train_report(
    stages: Sequence, labelled: DataFrame, names: Sequence[str], threshold: float = fv.REVIEW_THRESHOLD, seed: int = 42
) -> tuple[PipelineModel, DataFrame]:
    """Fit on 80 %, report on the rest: (metric, value) rows and one row per feature importance."""
    parts = cut_lineage(stratified_split(labelled, KEY, LABEL, 0.2, seed))
    model = fit(stages, parts.where("NOT is_test").drop("is_test"))
    held = cut_lineage(as_scored(score(model, parts.where("is_test"))))
    rate = labelled.agg(F.avg(LABEL).alias("value"), F.count(F.lit(1)).cast("double").alias("n"))
    rows = metrics.metric_rows(held, threshold).unionByName(
        metrics.roc_auc(held).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    ).unionByName(rate.select(F.lit("bid_rate").alias("metric"), "value")).unionByName(
        rate.select(F.lit("samples").alias("metric"), F.col("n").alias("value"))
    )
    return model, rows.unionByName(importances(model, names, held.sparkSession))


def importances(model: PipelineModel, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(metric, value) rows ``importance:<feature>`` of a tree model."""
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(f"importance:{n}", float(v)) for n, v in zip(names, values)], "metric string, value double"
    )


# -- reading a model ------------------------------------------------------------------------------

def block_names(model: PipelineModel, df: DataFrame) -> list[tuple[str, str]]:
    """(block, feature) for each place of ``features``, from the fitted stages."""
    by_output = {}
    for stage in model.stages:
        for inner in getattr(stage, "stages", [stage]):
            if inner.hasParam("outputCol") and inner.isSet("outputCol"):
                by_output[inner.getOutputCol()] = inner
    assembler = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler))
    sample = model.transform(df.limit(1)).select(*assembler.getInputCols()).first()
    out = []
    for block in assembler.getInputCols():
        size = sample[block].size
        vocabulary = None
        for name in (block, f"{block}_counts"):
            vocabulary = vocabulary or getattr(by_output.get(name), "vocabulary", None)
        index = by_output.get(f"{block}_index")
        labels = vocabulary or (list(index.labels) if index is not None and hasattr(index, "labels") else [])
        out += [(block, labels[i] if i < len(labels) else f"{block}_{i}") for i in range(size)]
    return out


def coef_report(model: PipelineModel, df: DataFrame, k: int = 10) -> DataFrame:
    """Coefficient norm of each block and its heaviest features of either sign."""
    weights = model.stages[-1].coefficients.toArray()
    names = block_names(model, df)
    rows = [(b, n, float(w)) for (b, n), w in zip(names, weights)]
    table = df.sparkSession.createDataFrame(rows, "block string, feature string, weight double")
    norms = table.groupBy("block").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("weight"))
    pick = lambda order, kind: table.orderBy(order, "feature").limit(k).select(
        F.lit(kind).alias("kind"), "block", "feature", "weight"
    )
    return norms.select(F.lit("norm").alias("kind"), "block", F.lit("").alias("feature"), "weight").unionByName(
        pick(F.desc("weight"), "positive")
    ).unionByName(pick(F.asc("weight"), "negative"))


def block_margins(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, list[str]]:
    """(key, label, parts): what each block of features adds to the margin of a linear model, and the blocks' names."""
    names = block_names(model, df)
    blocks = list(dict.fromkeys(b for b, _ in names))
    place = {b: k for k, b in enumerate(blocks)}
    owner, weights = np.array([place[b] for b, _ in names]), model.stages[-1].coefficients.toArray()
    held = df.sparkSession.sparkContext.broadcast((owner, weights))
    vectors = PipelineModel(model.stages[:-1]).transform(df)

    def sums(batches):
        owner, weights = held.value
        n = len(blocks)
        for batch in batches:
            places, x, row = lists(batch)
            parts = np.bincount(row * n + owner[places], x * weights[places], batch.num_rows * n)
            bounds = pa.array(np.arange(batch.num_rows + 1) * n, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(KEY), batch.column(LABEL), pa.ListArray.from_arrays(bounds, pa.array(parts))], names=[KEY, LABEL, "parts"])

    rows = sparse_rows(vectors, model.stages[-1].getFeaturesCol(), [KEY, LABEL])
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(sums, f"{KEY} {kinds[KEY]}, {LABEL} {kinds[LABEL]}, parts array<double>"), blocks


def ablation_rows(margins: DataFrame, blocks: Sequence[str], intercept: float, variants: dict[str, Sequence[str]], limit: float = 0.0) -> DataFrame:
    """(variant, accuracy, drop) from the parts of the margins, in one pass; a row is positive from ``limit`` on."""
    total = F.aggregate("parts", F.lit(float(intercept)), lambda a, x: a + x)

    def right(omitted: Sequence[str]) -> Column:
        left_out = reduce(lambda a, b: a + b, [F.get("parts", F.lit(blocks.index(b))) for b in omitted], F.lit(0.0))
        return ((total - left_out >= limit) == (F.col(LABEL) == 1)).cast("double")

    every = {"full": (), **variants}
    one = margins.agg(*[F.avg(right(v)).alias(f"v{k}") for k, v in enumerate(every.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("variant"), F.col(f"v{k}").alias("accuracy"), (F.col("v0") - F.col(f"v{k}")).alias("drop")) for k, name in enumerate(every)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def block_ablation(model: PipelineModel, df: DataFrame, variants: dict[str, Sequence[str]]) -> DataFrame:
    """Accuracy of a linear model with blocks of features left out, and what it costs against the full margin."""
    margins, blocks = block_margins(model, df)
    return ablation_rows(margins, blocks, model.stages[-1].intercept, variants)


def svd_project(vectors: DataFrame, column: str, k: int, output: str = "projected") -> tuple[DataFrame, list[float]]:
    """Rows in the first ``k`` latent dimensions as an array, and the singular values."""
    model = LatentProjection(column, "_latent", k).fit(vectors)
    projected = model.transform(vectors).withColumn(output, vector_to_array("_latent")).drop("_latent")
    return projected, [float(v) for v in model.singular_values]


# -- keeping a model ------------------------------------------------------------------------------

@dataclass
class SavedModel:
    model: PipelineModel
    threshold: float
    names: list[str] = field(default_factory=list)


def save_model(spark: SparkSession, model: PipelineModel, path: str, threshold: float, names: Sequence[str]) -> None:
    """The fitted stages, and beside them the threshold and feature names."""
    model.write().overwrite().save(f"{path}/stages")
    row = [(json.dumps({"threshold": threshold, "names": list(names)}),)]
    spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> SavedModel:
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
    return SavedModel(PipelineModel.load(f"{path}/stages"), settings["threshold"], settings["names"])
