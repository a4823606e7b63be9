"""Lexicon counts against brute force, codes by all three ways, the rule and its edges."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.operators import lexicon, scoring
from sievework.operators import containment
from sievework.operators.containment import detect_codes


def brute_force(title, text):
    """Counts over the joined text, one regular expression per entry."""
    joined = f"{title} {text}".lower()
    words = len(joined.split())
    whole = lambda t: len(re.findall(rf"\b{re.escape(t)}\b", joined))
    points = sum(2.0 * whole(t) for t in fv.HEAVY_EXCLUSION_TERMS) + sum(whole(t) for t in fv.EXCLUSION_TERMS)
    points += sum(1.5 * len(re.findall(re.escape(p), joined)) for p in fv.EXCLUSION_PHRASES)
    exclusion = min(points / words * 50, 15.0) if words else 0.0
    terms = {t: min(whole(t) / words * w, 1.0) if words else 0.0 for t, w in fv.KEY_TERMS.items()}
    return exclusion, terms


def made_texts(n=150):
    rng = random.Random(7)
    words = [*fv.KEY_TERMS, *fv.EXCLUSION_TERMS, *fv.EXCLUSION_PHRASES, *fv.HEAVY_EXCLUSION_TERMS, "the", "of", "Été", "roads", "école,"]
    glue = [" ", " ", "  ", "\n", ", ", "-", "."]

    def text(k):
        out = ""
        for _ in range(rng.randrange(k)):
            out += rng.choice(words) + rng.choice(glue)
        return out.upper() if rng.random() < 0.2 else out

    # Ends that complete a phrase across the seam, too.
    return [(i, text(6) + rng.choice(["", "road", "school", "air", "civil"]), rng.choice(["", "works ", "meals", "conditioning"]) + text(60))
            for i in range(n)]


def check(rows, sources):
    for row in rows:
        exclusion, terms = brute_force(*sources[row["resource_id"]])
        assert math.isclose(row["exclusion_score"], exclusion, abs_tol=1e-9), sources[row["resource_id"]]
        for term, value in terms.items():
            assert math.isclose(row[f"tfidf_{term}"], value, abs_tol=1e-12)


def test_lexicon_equals_brute_force(spark):
    data = made_texts()
    df = spark.createDataFrame(data, "resource_id int, title string, pdf_text string")
    sources = {i: (a, b) for i, a, b in data}
    check(lexicon.lexicon_features(df).collect(), sources)
    # The same from counts that were taken before the texts were left behind.
    docs = scoring.doc_features(df.select("resource_id", "pdf_text"))
    assert "pdf_text" not in docs.columns
    check(lexicon.lexicon_features(df.drop("pdf_text").join(docs, "resource_id", "left")).collect(), sources)


def test_entries_that_overlap_themselves(spark):
    """Chains of overlapping entries that start in the title and go on for any length in the text."""
    chain = "school meal" * 9
    data = [(i, "x " + chain[:a], chain[b:] + "s and more") for i, (a, b) in enumerate((a, b) for a in range(0, 40) for b in range(0, 25))]
    data += [(len(data) + i, "food " * a, "food " * b) for i, (a, b) in enumerate((a, b) for a in range(5) for b in range(9))]
    df = spark.createDataFrame(data, "resource_id int, title string, pdf_text string")
    for lex, pattern in (
        (lexicon.Lexicon(terms=(), heavy_terms=(), phrases=("school meals",), per_words=1.0, cap=1e9), r"school meals"),
        (lexicon.Lexicon(terms=("food food",), heavy_terms=(), phrases=(), per_words=1.5, cap=1e9), r"\bfood food\b"),
    ):
        docs = scoring.doc_features(df.select("resource_id", "pdf_text"), lex)
        rows = lexicon.lexicon_features(df.drop("pdf_text").join(docs, "resource_id"), lex).collect()
        for row in rows:
            joined = f"{data[row['resource_id']][1]} {data[row['resource_id']][2]}"
            want = len(re.findall(pattern, joined)) * 1.5 / max(len(joined.split()), 1)
            assert math.isclose(row["exclusion_score"], want), joined


def test_term_scores_of_the_sample(spark):
    df = spark.createDataFrame([("", "software development technical support computer systems"), ("", "")], "title string, pdf_text string")
    full, empty = lexicon.lexicon_features(df).orderBy(F.desc("n_words")).collect()
    for term in ("software", "support", "computer", "systems", "technical"):
        assert full[f"tfidf_{term}"] > 0
    assert all(empty[f"tfidf_{t}"] == 0.0 for t in fv.KEY_TERMS)


def test_authority(spark):
    names = ["Health Service Executive", "The Health Service Executive, Cork", "Irish", "Somewhere Else", ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, ca string")
    got = [r["c"] for r in df.select("i", lexicon.encode_authority("ca").alias("c")).orderBy("i").collect()]
    assert got[:3] == [1.0, 1.0, 9.0] and 11 <= got[3] <= 100 and got[4] == 1.0


def test_codes_in_the_sample(spark):
    docs = spark.createDataFrame([(1, "see 72400000, 72000000 and x72200000y; 999")], "resource_id long, pdf_text string")
    codes = spark.createDataFrame([("72000000", 0), ("72200000", 1), ("48000000", 2), ("72400000", 3)], "code string, code_pos int")
    assert detect_codes(docs, codes).first()["detected_codes"] == ["72000000", "72200000", "72400000"]


@pytest.mark.parametrize("letters", ["0123456789", "ab c", "aé日 🙂"])
@pytest.mark.parametrize("hot", [False, True])
def test_codes_equal_brute_force(spark, monkeypatch, letters, hot):
    if hot:
        monkeypatch.setattr(containment, "HOT_ROWS", 3)
        monkeypatch.setattr(containment, "HOT_SHARE", 50)
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    codes = list(dict.fromkeys([word(rng.randrange(1, 40)) for _ in range(60)] + ["a", letters, letters * 3]))
    texts = [word(rng.randrange(200)) + rng.choice(codes) + " x " + rng.choice(codes) for _ in range(60)] + ["", None, codes[0], codes[5][1:], word(5) * 4000]
    # One text in three is the same, and some ids hold several texts.
    texts += [texts[0]] * 30
    keys = [k % 80 if k % 7 else None for k in range(len(texts))]
    docs = spark.createDataFrame(list(zip(keys, range(len(texts)), texts)), "resource_id long, n int, pdf_text string")
    entries = [(c, i) for i, c in enumerate(codes)] + [(codes[0], 99), ("", 100), (None, 101)]
    detect = containment.code_detector(spark.createDataFrame(entries, "code string, code_pos int"))
    want = {i: [c for c in codes if t and c in t] for i, t in enumerate(texts)}
    for keep in (None, lambda d: d.drop("pdf_text")):
        rows = detect(docs, keep).collect()
        assert {r["n"]: r["detected_codes"] for r in rows} == want and len(rows) == len(texts)
        assert all(r["codes_count"] == len(r["detected_codes"]) for r in rows)
    assert detect(docs.limit(0)).collect() == []


def test_no_codes_at_all(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "resource_id long, pdf_text string")
    for entries in ([], [("", 1)], [("never there", 1)]):
        rows = detect_codes(docs, spark.createDataFrame(entries, "code string, code_pos int")).collect()
        assert [(r["detected_codes"], r["codes_count"]) for r in rows] == [([], 0)] * 2


NAMES = scoring.feature_names(lexicon.Lexicon())


def features(spark, **values):
    row = {n: 0.0 for n in NAMES} | values
    return spark.createDataFrame([tuple(row.values()) + ("text",)], ", ".join(f"{n} double" for n in row) + ", pdf_text string")


def test_decision_turns_between_exclusion_3_5_and_3_6(spark):
    # With no other feature the score sinks and the limit rises; a code keeps the soft exclusion away.
    for exclusion, score in ((3.5, 0.1571), (3.6, 0.1508)):
        df = features(spark, exclusion_score=exclusion)
        got = df.select(scoring.linear_score(NAMES).alias("s")).first()["s"]
        assert abs(got - score) < 1e-4
        limit = fv.RULE_THRESHOLD * (1 + exclusion * 0.5)
        assert (got >= limit) == (exclusion == 3.5)


def test_exclusion_levels(spark):
    decide = lambda **v: scoring.decide(features(spark, **v), NAMES).first()
    hard = decide(exclusion_score=4.1, codes_count=3.0)
    assert (hard["decision"], hard["ml_bid"], hard["ml_confidence"]) == ("HARD_EXCLUSION", False, 0.0)
    soft = decide(exclusion_score=2.1)
    assert (soft["decision"], soft["ml_bid"], soft["ml_confidence"]) == ("SOFT_EXCLUSION", False, 0.01)
    kept = decide(exclusion_score=2.1, codes_count=2.0, has_codes=1.0)
    assert kept["decision"] == "SCORED" and kept["ml_bid"] is True
    assert kept["ml_reasoning"].startswith("HIGH_CONFIDENCE_BID: ⚠️ High exclusion score: 2.1") and "adjusted threshold: 11%" in kept["ml_reasoning"]


def test_normalisation(spark):
    df = features(spark, codes_count=5.0, has_codes=1.0, title_length=150.0, ca_encoded=50.0, exclusion_score=0.5, tfidf_software=0.3)
    row = scoring.normalize_features(df, NAMES).first()
    assert [row[n] for n in NAMES[:7]] == [0.25, 1.0, 0.75, 0.5, 0.05, 0.3, 0.0]


def test_components_leave_out_the_last_term(spark):
    df = features(spark, exclusion_score=5.0, tfidf_software=1.0, tfidf_technical=1.0)
    scores = df.select(scoring.component_scores(NAMES).alias("s")).first()["s"]
    assert math.isclose(scores["text_features_score"], -0.4 + 0.08)
    assert math.isclose(scores["total_score"], -0.4 + 0.08 + 0.003)


def test_sample_notice(spark):
    df = spark.createDataFrame(
        [("Software Development Services", "Health Service Executive", "software services text", 3)],
        "title string, ca string, pdf_text string, codes_count int",
    )
    row = scoring.predict_rule(df).first()
    assert row["ml_confidence"] > 0 and "3 relevant IT codes" in row["ml_reasoning"] and row["ml_status"] == "bid"


def test_blank_text_is_not_scored(spark):
    df = spark.createDataFrame([("t", "c", " \n", 0)], "title string, ca string, pdf_text string, codes_count int")
    row = scoring.predict_rule(df).first()
    assert (row["ml_status"], row["ml_confidence"], row["ml_bid"]) == ("routing_error", 0.0, None)


def test_review_queue(spark):
    df = spark.createDataFrame(
        [("a", "x" * 50, 0.9), ("b", "x" * 51, 0.05), ("c", "x" * 51, 0.0499), ("d", None, 0.9)],
        "title string, pdf_text string, probability double",
    )
    rows = {r["title"]: r for r in scoring.review_category(df).collect()}
    assert [rows[k]["category"] for k in "abcd"] == ["NO_PDF_DATA", "ML_PREDICTED_BID", "ML_PREDICTED_NO_BID", "NO_PDF_DATA"]
    assert rows["b"]["message"].endswith("(5.0% confidence)") and rows["b"]["requires_summary"] and rows["a"]["ml_probability"] is None


def test_fixed_decimals_round_the_binary_value(spark):
    df = spark.createDataFrame([(0.15,), (0.25,), (12.5,), (0.05,)], "x double")
    got = [r[0] for r in df.select(scoring.fixed_decimals(F.col("x"), 1)).collect()]
    assert got == [f"{x:.1f}" for x in (0.15, 0.25, 12.5, 0.05)]


def test_tfidf_has_unit_length(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "b"), (3, "none here")], "k long, t string")
    rows = {r["k"]: r for r in lexicon.fixed_vocabulary_tfidf(df, ["k"], F.col("t"), ["a", "b"]).collect()}
    idf_a, idf_b = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    length = math.hypot(2 * idf_a, idf_b)
    assert math.isclose(rows[1]["tfidf_a"], 2 * idf_a / length) and math.isclose(rows[1]["tfidf_b"], idf_b / length)
    assert (rows[2]["tfidf_b"], rows[3]["tfidf_a"], rows[3]["tfidf_b"]) == (1.0, 0.0, 0.0)
