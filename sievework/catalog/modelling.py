"""Encoders with SQL twins, and model fits whose rows are checked by their properties."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from sievework.adapters import TEST_LEXICON
from sievework.catalog.base import DOCS, HITS, NOTICES, query, with_
from sievework.catalog.texts import JOINED
from sievework.operators import encode, lexicon, ml, search
from sievework.operators.linear import sparse_rows
from sievework.session import cut_lineage, shared_folder

TERMS = list(TEST_LEXICON.key_terms)
STOP = ("the", "and", "of", "der", "die", "le", "la")


# -- encoders -------------------------------------------------------------------------------------

@query("code_onehot", with_(DOCS, HITS, """
names AS (SELECT list(DISTINCT c ORDER BY c) AS all_codes FROM (SELECT unnest(detected_codes) AS c FROM coded))""", select="""
SELECT resource_id, array_to_string(list_transform(all_codes, lambda x: CASE WHEN list_contains(detected_codes, x) THEN '1' ELSE '0' END), '') AS bits
FROM coded, names"""))
def _(t):
    marked = encode.code_bits(cut_lineage(t.coded.select("resource_id", "detected_codes")))
    return marked.select("resource_id", F.array_join(F.transform("bits", lambda b: b.cast("string")), "").alias("bits"))


@query("label_encode", with_(NOTICES, """
seen AS (SELECT ca, row_number() OVER (ORDER BY ca) - 1 AS code FROM (SELECT DISTINCT ca FROM notices WHERE status = 'Open'))""", select="""
SELECT resource_id, coalesce(s.code, -1) AS ca_encoded FROM notices n LEFT JOIN seen s USING (ca)"""))
def _(t):
    codes = encode.label_codes(t.notices.where("status = 'Open'"), "ca")
    return encode.label_encode(t.notices, "ca", codes, unseen=-1).select("resource_id", "ca_encoded")


@query("scale_features", """
SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
 round((l_discount - (SELECT avg(l_discount) FROM lineitem)) / (SELECT stddev_pop(l_discount) FROM lineitem), 6) AS l_discount FROM lineitem""")
def _(t):
    scaled = encode.scale_features(t.raw("lineitem"), ["l_quantity", "l_discount"])
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("l_quantity", "l_discount")])


WORDS = r"list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^\pL\pM\p{Nd}\p{Pc}]+'), lambda x: length(x) >= 2)"


@query("tfidf_terms", f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: concat(words[i], ' ', words[i + 1])))) AS term FROM w),
per_doc AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
per_term AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM per_doc GROUP BY 1)
SELECT term, tf, df, round(ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0, 14) AS idf FROM per_term
WHERE df >= 3 AND df <= 0.8 * (SELECT count(*) FROM documents) ORDER BY tf DESC, term LIMIT 500""")
def _(t):
    return encode.tfidf_terms(t.raw("documents"), F.col("text"), 3, 0.8, 500)


def _fixed_sql(source: str, text: str, keys: str) -> str:
    """TF-IDF on the ten terms in SQL, as the CTE ``weighted``."""
    count = lambda t: f"len(list_filter(toks, lambda x: x = '{t}'))"
    return f"""vocab AS (SELECT {keys}, {', '.join(f"{count(t)} AS n_{t}" for t in TERMS)} FROM
 (SELECT *, regexp_split_to_array(lower({text}), '[^\\pL\\pM\\p{{Nd}}\\p{{Pc}}]+') AS toks FROM {source})),
stats AS (SELECT count(*) AS n, {', '.join(f"count(CASE WHEN n_{t} > 0 THEN 1 END) AS df_{t}" for t in TERMS)} FROM vocab),
raw_w AS (SELECT {keys}, {', '.join(f"n_{t} * (ln((n + 1.0) / (df_{t} + 1.0)) + 1.0) AS w_{t}" for t in TERMS)} FROM vocab, stats),
weighted AS (SELECT {keys}, {', '.join(f"coalesce(w_{t} / nullif(sqrt({' + '.join(f'w_{u} * w_{u}' for u in TERMS)}), 0), 0) AS tfidf_{t}" for t in TERMS)} FROM raw_w)"""


@query("tfidf_fixed_vocab", with_(_fixed_sql("documents", "text", "doc_id"), select=f"""
SELECT doc_id, {', '.join(f'round(tfidf_{t}, 14) AS tfidf_{t}' for t in TERMS)} FROM weighted"""))
def _(t):
    return lexicon.fixed_vocabulary_tfidf(t.raw("documents"), ["doc_id"], F.col("text"), TERMS)


@query("tokenize", f"""
SELECT doc_id, len(words) AS n, md5(array_to_string(words, ' ')) AS words_md5 FROM (
 SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\pL\\pM\\p{{Nd}}\\p{{Pc}}]+'),
  lambda x: regexp_full_match(x, '[a-z][a-z]+') AND NOT list_contains(['{"', '".join(STOP)}'], x)) AS words FROM documents)""")
def _(t):
    words = encode.tokenize("text", STOP)
    return t.raw("documents").select("doc_id", F.size(words).alias("n"), F.md5(F.array_join(words, " ")).alias("words_md5"))


@query("class_weights", with_(NOTICES, select="""
SELECT resource_id, CAST(bid AS BIGINT) AS bid, round((p + q) / (2.0::DOUBLE * CASE WHEN bid = 1 THEN p ELSE q END), 14) AS weight
FROM notices, (SELECT count(CASE WHEN bid = 1 THEN 1 END) AS p, count(CASE WHEN bid = 0 THEN 1 END) AS q FROM notices) WHERE bid IS NOT NULL"""))
def _(t):
    return encode.class_weights(search.clean_frame(t.notices)).select("resource_id", "bid", "weight")


@query("feature_matrix", with_(NOTICES, DOCS, HITS, JOINED, """
ca_codes AS (SELECT ca, row_number() OVER (ORDER BY ca) - 1 AS ca_encoded FROM (SELECT DISTINCT ca FROM notices))""",
    _fixed_sql("joined", "concat(title, ' ', pdf_text)", "resource_id"), select=f"""
SELECT j.resource_id, j.bid, codes_count::DOUBLE AS codes_count, CASE WHEN codes_count > 0 THEN 1.0 ELSE 0.0 END AS has_codes,
 length(title) AS title_length, length(pdf_text) AS text_length, c.ca_encoded, {', '.join(f'round(w.tfidf_{t}, 14) AS tfidf_{t}' for t in TERMS)}
FROM joined j JOIN ca_codes c USING (ca) JOIN weighted w ON j.resource_id = w.resource_id"""))
def _(t):
    return encode.feature_matrix(t.notices, t.coded, TERMS, encode.label_codes(t.notices, "ca"), with_text_length=True)


@query("rare_to_null", """
SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY user_id) >= 215 THEN user_id END AS user_id FROM events""")
def _(t):
    return encode.rare_to_null(t.raw("events").select("event_id", "user_id"), "user_id", 215)


# -- splits ---------------------------------------------------------------------------------------

@query("stratified_folds", with_(NOTICES, select="""
SELECT bid, i AS fold, CAST(ceil((i + 1) * n / 5.0) - ceil(i * n / 5.0) AS BIGINT) AS n
FROM (SELECT CAST(bid AS BIGINT) AS bid, count(*) AS n FROM notices WHERE bid IS NOT NULL GROUP BY 1), range(5) r(i)"""))
def _(t):
    folds = encode.stratified_folds(search.clean_frame(t.notices), "resource_id", "bid")
    return folds.groupBy("bid", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_split", with_(NOTICES, select="""
SELECT bid, x.is_test, CASE WHEN x.is_test THEN CAST(round(n * 0.2) AS BIGINT) ELSE n - CAST(round(n * 0.2) AS BIGINT) END AS n
FROM (SELECT CAST(bid AS BIGINT) AS bid, count(*) AS n FROM notices WHERE bid IS NOT NULL GROUP BY 1), (VALUES (true), (false)) x(is_test)"""))
def _(t):
    split = encode.stratified_split(search.clean_frame(t.notices), "resource_id", "bid")
    return split.groupBy("bid", "is_test").agg(F.count(F.lit(1)).alias("n"))


# -- models ---------------------------------------------------------------------------------------

def _labelled(t, text: bool = False):
    """Labelled notices, written once; with their texts, codes and flags when asked."""
    if not text:
        return cut_lineage(search.clean_frame(t.notices))
    return cut_lineage(search.modeling_dataset(t.notices, t.coded, section_only=False, min_text_length=50))


TITLE = partial(ml.feature_stages, text=("title",), categories=("ca", "procedure"), min_df=3, vocab_size=20_000)
ENRICHED = partial(
    ml.feature_stages, text=("title", "pdf_text"), categories=("ca",), numbers=("codes_count", "pdf_text_length"),
    codes="detected_codes", min_df=3, vocab_size={"title": 20_000, "pdf_text": 30_000},
)


def _with(stages, kind: str, **options):
    return lambda: [*stages(), ml.classifier(kind, **options)]


LOGREG = _with(TITLE, "logreg")
SVM = _with(TITLE, "svm")
LOGREG_TEXT = _with(ENRICHED, "logreg")
SVM_TEXT = _with(ENRICHED, "svm")
SIZES = (0.2, 0.36, 0.52, 0.68, 0.84, 1.0)


def _entries(vectors):
    """The entries of the sparse vectors, one row each."""
    rows = sparse_rows(vectors, "features", ["resource_id"])
    return rows.select("resource_id", F.explode(F.arrays_zip("places", "x")).alias("e")).select("resource_id", "e.places", "e.x").withColumnRenamed("places", "place")


@query("feature_blocks")
def _(t):
    df = _labelled(t, text=True)
    return _entries(ml.fit(ENRICHED(), df).transform(df))


@query("count_vectors", with_(NOTICES, r"""
words AS (SELECT resource_id, list_filter(regexp_split_to_array(lower(title), '[^\pL\pM\p{Nd}\p{Pc}]+'), lambda x: length(x) >= 2 AND x <> 'urgent') AS words
 FROM notices WHERE bid IS NOT NULL),
vocab AS (SELECT list(term) AS terms FROM (SELECT term FROM (SELECT resource_id, unnest(list_distinct(words)) AS term FROM words) GROUP BY term HAVING count(*) >= 3))""", select="""
SELECT resource_id, len(list_filter(words, lambda x: list_contains(terms, x)))::DOUBLE AS n_terms FROM words, vocab"""))
def _(t):
    df = _labelled(t)
    stages = ml.text_stages("title", "features", kind="count", bigrams=False, stop_words=("urgent",))
    vectors = ml.fit(stages, df).transform(df)
    rows = sparse_rows(vectors, "features", ["resource_id"])
    return rows.select("resource_id", F.aggregate("x", F.lit(0.0), lambda a, x: a + x).alias("n_terms"))


@query("hash_vectors")
def _(t):
    df = _labelled(t)
    stages = ml.text_stages("title", "features", kind="hash", bigrams=False, hash_size=1 << 18)
    return _entries(ml.fit(stages, df).transform(df))


@query("train_logreg")
def _(t):
    df = _labelled(t)
    return ml.score(ml.fit(LOGREG(), df), df)


@query("train_svm")
def _(t):
    df = _labelled(t)
    return ml.score(ml.fit(SVM(), df), df)


@query("train_forest")
def _(t):
    df = _matrix(t)
    names = [c for c in df.columns if c not in ("resource_id", "bid")]
    return ml.score(ml.fit(_forest_stages(names, trees=100, depth=10), df), df)


@query("train_tree")
def _(t):
    """A tree on the latent dimensions of the title, its length, and the categories."""
    df = _labelled(t).withColumn("title_length", F.length("title").cast("double"))
    return ml.score(ml.fit(ml.projected_tree_stages(stop_words=STOP), df), df)


@query("train_dense")
def _(t):
    vectors = t.raw("embeddings").select(
        F.col("vec_id").alias("resource_id"), "embedding", (F.col("label") == 0).cast("int").alias("bid")
    )
    df = cut_lineage(vectors)
    return ml.score(ml.fit([*ml.dense_stages(), ml.classifier("logreg")], df), df)


@query("calibrate")
def _(t):
    df = _labelled(t)
    return ml.calibrate(SVM, df).score(df)


@query("oof_predictions")
def _(t):
    return ml.oof_predictions(ml.trainer(LOGREG), _labelled(t))


@query("cv_scores")
def _(t):
    return ml.cv_scores(ml.trainer(LOGREG), _labelled(t))


@query("learning_curve")
def _(t):
    return ml.learning_curve(ml.trainer(LOGREG), _labelled(t), SIZES)


@query("evaluate_model")
def _(t):
    return ml.evaluate_model(ml.trainer(LOGREG, calibrated=True), _labelled(t), 0.85)


@query("compare_models")
def _(t):
    return ml.compare_models(ml.trainer(SVM, calibrated=True), ml.trainer(SVM_TEXT, calibrated=True), _labelled(t, text=True), 0.85)


def _matrix(t):
    """The features of the trained predictor for labelled notices."""
    labelled = t.notices.where(F.col("bid").isNotNull())
    return cut_lineage(encode.feature_matrix(labelled, t.coded, TERMS, encode.label_codes(t.notices, "ca")))


def _forest_stages(names, trees: int = 50, depth: int = 8):
    from pyspark.ml.feature import VectorAssembler

    return [
        VectorAssembler(inputCols=names, outputCol="raw"), ml.PopulationScaler("raw", "features"),
        ml.classifier("forest", trees=trees, depth=depth),
    ]


@query("train_report")
def _(t):
    df = _matrix(t)
    names = [c for c in df.columns if c not in ("resource_id", "bid")]
    return ml.train_report(_forest_stages(names), df, names)[1]


@query("score_batch")
def _(t):
    df = _matrix(t)
    names = [c for c in df.columns if c not in ("resource_id", "bid")]
    return ml.score_batch(ml.fit(_forest_stages(names), df), df.drop("bid"))


@query("model_roundtrip")
def _(t):
    """Scores of a saved and reloaded model next to those of the model itself."""
    df = _labelled(t)
    model = ml.fit(LOGREG(), df)
    path = f"{shared_folder(t.spark)}/model-{uuid.uuid4().hex}"
    ml.save_model(t.spark, model, path, 0.05, ["title", "ca", "procedure"])
    loaded = ml.load_model(t.spark, path)
    again = ml.score_batch(loaded.model, df, loaded.threshold).withColumnRenamed("score", "score_loaded")
    return ml.score(model, df).join(again.drop("bid"), "resource_id")


@query("block_ablation")
def _(t):
    df = _labelled(t, text=True)
    blocks = {"no text": ["title_vector", "pdf_text_vector"], "no category": ["ca_onehot"], "no codes": ["codes_vector", "numbers_vector"]}
    return ml.block_ablation(ml.fit(LOGREG_TEXT(), df), df, blocks)


@query("coef_report")
def _(t):
    df = _labelled(t)
    return ml.coef_report(ml.fit(LOGREG(), df), df)


@query("svd_project")
def _(t):
    df = t.raw("documents").select(F.col("doc_id").alias("resource_id"), F.col("text").alias("title"), F.lit(0).alias("bid"))
    stages = ml.text_stages("title", "features", vocab_size=40_000, stop_words=STOP)
    vectors = cut_lineage(ml.fit_features(stages, df).transform(df).select("resource_id", "features"))
    projected, _values = ml.svd_project(vectors, "features", 2)
    return projected.select("resource_id", F.col("projected")[0].alias("x"), F.col("projected")[1].alias("y"))
