"""The operators against brute force, libraries and planted cases, on small tables with odd rows."""

import base64
import hashlib
import math
import os
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sievework.llm import common, decontaminate, langid, licenses, minhash, ngram_lm, pivot_index, sentencepiece_fst, token_counts, toxicity, warc
from sievework.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, score string, rows int"
ODD = [
    (None, None, None, "x", 1), (1, "", "en", None, 2), (2, None, "en", "x", 3), (3, " \n\t ", None, "x", 4),
    (4, "a b c d e f g h", "en", "x", 5), (4, "a b c d e f g h", "en", "x", 5), (5, "A b C d e f g h", "de", "x", 6),
    (6, "one", "en", "x", 7), (7, "word " * 30_000, "en", "x", 8), (8, "naïve Ünïcode 日本語 🙂 \x00 ▁ ▁▁", "fr", "x", 9),
]


def lower(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def words(text):
    return WORD.findall(lower(text or ""))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


# ---- near duplicates


def shingle_set(text, size):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(sets, percent):
    """Smallest id reachable by links, over all pairs."""
    up = {k: k for k in sets}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {k: top(k) for k in keys}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, texts, size):
    rng = random.Random(3)
    rows = [(i, t) for i, t, _ in texts[:80]]
    for k in range(40):            # a group of near copies that are not all near to each other
        w = ("base text of a group " + " ".join(f"w{j}" for j in range(60))).split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((1000 + k, " ".join(w)))
    want = components({i: shingle_set(t, size) for i, t in rows}, 80)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingle_set(dict(rows)[r.doc_id], size)) for r in got)


def test_near_duplicates_of_odd_rows(odd, nothing):
    got = minhash.near_duplicates(odd, size=2).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got) == sorted(
        [(-1, 0, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 7, 4), (4, 7, 4), (5, 7, 4), (6, 1, 6), (7, 1, 7), (8, len(words(ODD[-1][1])) - 1, 8)], key=lambda r: (r[0], r[1], r[2] or 0))
    kept = minhash.without_near_duplicates(odd, size=2)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8]
    assert minhash.near_duplicates(nothing).collect() == []


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(0)
    import pyarrow as pa
    for _ in range(200):
        a = rng.integers(0, 1 << 16, minhash.VALUES).astype(np.uint16)
        b = a.copy()
        at = rng.choice(minhash.VALUES, minhash.DISTANCE, replace=False)
        b[at] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()])], names=["cls", "comp", "sig"])
        keys = defaultdict(set)
        for out in minhash.chunk_keys([batch], minhash.CHUNKS):
            for k, c in zip(out.column("key").to_pylist(), out.column("cls").to_pylist()):
                keys[k].add(c)
        assert any(len(c) == 2 for c in keys.values())


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = {r.node: r.component for r in common.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = {n: {n} for e in edges if e[0] != e[1] for n in e}
    for a, b in edges * 2:
        if a != b and sets[a] is not sets[b]:
            sets[a] |= sets[b]
            for n in list(sets[a]):
                sets[n] = sets[a]
    assert got == {n: min(s) for n, s in sets.items()}


# ---- language model


def test_language_model_equals_brute_force(spark, texts):
    docs = [(i, t) for i, t, _ in texts] + [(9001, None), (9002, ""), (None, "a b"), (9003, "a b a b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    model = ngram_lm.fit(frame.where(~common.in_fold(F.col("doc_id"), 10, 0)))
    got = {r.doc_id: r for r in ngram_lm.score(frame, model).collect()}
    end = "</s>"
    streams = {i: words(t) + [end] for i, t in docs}
    counts, pairs = Counter(), Counter()
    for i, s in streams.items():
        if not held[i]:
            counts.update(s)
            pairs.update(zip([end, *s], s))

    def discounts(values):
        n = [sum(v == k for v in values) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]

    preceded = Counter(w for _, w in pairs)
    d2, d1 = discounts(pairs.values()), discounts(preceded.values())
    n, v, total = sum(counts.values()), len(counts), len(pairs)
    floor = sum(d1[min(c, 3)] for c in preceded.values()) / total / (v + 1)
    left = defaultdict(float)
    for (u, _), c in pairs.items():
        left[u] += d2[min(c, 3)] / counts[u]
    low = lambda w: floor + (preceded[w] - d1[min(preceded[w], 3)]) / total
    p = lambda u, w: low(w) if u not in counts else (pairs[u, w] - d2[min(pairs[u, w], 3)]) / counts[u] + left[u] * low(w)
    for i, s in streams.items():
        assert got[i].score == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([end, *s], s)), abs=1e-6)
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + .1) / (n + .1 * (v + 1))) for w in s), abs=1e-6)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(s), sum(w in counts for w in s), n)
    assert sum(p("the", w) for w in counts) + left["the"] * floor == pytest.approx(1)


def test_language_model_without_rows(odd, nothing):
    model = ngram_lm.fit(nothing)
    assert ngram_lm.score(nothing, model).collect() == []
    assert {r.score for r in ngram_lm.score(odd, model).collect()} == {0.0}


def test_mixing_is_undone():
    x = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (ngram_lm.unmix(common.mix(x)) == x).all()
    assert (ngram_lm.unpack(ngram_lm.pack(x), np.uint64) == x).all()


# ---- tokenizers


def random_texts(alphabet, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def test_encoding_equals_the_library(spark, texts, odd, nothing):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [t for _, t, _ in texts] + ["", " ", "  a ", "a  ", "▁ a▁ b", "$$$$$", None]
    rows += random_texts([" ", " ", "▁", "\n", "\t", *"abdeinth.,!$&é", "日本", "🙂", "\x00", "<s>", "0x1F", "́"], 3000, 1)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in sentencepiece_fst.encode(frame, path).collect()}
    for k, t in enumerate(rows):
        want = library.encode(t or "")
        assert list(got[k].ids) == want and got[k].n_tokens == len(want)
        assert got[k].round_trip == ("▁" not in (t or ""))
    back = {r.doc_id: r.text for r in sentencepiece_fst.decode(sentencepiece_fst.encode(frame, path), path).collect()}
    assert back == {k: (t or "").replace("▁", " ") for k, t in enumerate(rows)}
    assert sentencepiece_fst.encode(odd, path).columns == ["doc_id", "lang", "score", "rows", "ids", "n_tokens", "round_trip"]
    assert sentencepiece_fst.encode(odd, path).count() == len(ODD) and sentencepiece_fst.encode(nothing, path).count() == 0


def test_token_counts_equal_the_library(spark, texts, odd, nothing, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [t for _, t, _ in texts] + [None, "", " \n", "a  b", " a\tb "]
    rows += random_texts([" ", "\n", "\x0b", "\x85", "\xa0", *"aBÉé", "́", "Σ", "'s", "12", "<|endoftext|>", "<|", "日本", "🙂", "\x00"], 3000, 2)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    cache = str(tmp_path / "cache")
    got = {r.doc_id: r for r in token_counts.count_tokens(frame, path, cache).collect()}
    for k, t in enumerate(rows):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 2048)
    held = spark.read.parquet(cache)
    stored = held.count()
    assert stored == held.select("content").distinct().count() <= len(set(rows))
    assert token_counts.count_tokens(frame.limit(50).union(odd.select("doc_id", "text")), path, cache).where("n_tokens is null").count() == 0
    assert token_counts.count_tokens(nothing, path).collect() == []


def test_a_filled_cache_is_used(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    version = token_counts.fill_cache(frame, path, cache)
    spark.createDataFrame([(spark.range(1).select(token_counts.content_digest(F.lit("other"))).first()[0], version, 77)], token_counts.CACHE).write.mode("append").parquet(cache)
    other = spark.createDataFrame([(2, " other ")], "doc_id long, text string")
    assert token_counts.count_tokens(other, path, cache).first().n_tokens == 77


# ---- classifiers


def test_toxicity_finds_planted_words(spark, nothing, odd):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(500):
        w = rng.choices(vocabulary, k=rng.randrange(10, 60))
        bad = i % 4 == 0
        for _ in range(2 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["zorkle", "quibnax"]))
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels[:350] + [(None, 1), (3, None)], "doc_id long, toxic int")
    net = toxicity.fit(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    right = sum((got[i] >= 0.3) == bool(y) for i, y in labels[350:])
    assert right >= 0.95 * len(labels[350:])
    out = toxicity.score(odd, net, keep_text=True)
    assert out.columns == ["doc_id", "text", "lang", "rows", "score"] and out.where("score between 0 and 1").count() == len(ODD)
    constant = toxicity.fit(docs, marks.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, constant).collect()} == {0.0}
    assert toxicity.score(nothing, toxicity.fit(nothing, marks)).collect() == []


def test_toxicity_learns_nothing_from_other_labels(spark, monkeypatch):
    """Labels of rows outside ``documents`` change no score, also where only a share of the rows is drawn."""
    monkeypatch.setattr(toxicity, "SAMPLE_POSITIVE", 40)
    monkeypatch.setattr(toxicity, "SAMPLE_NEGATIVE", 60)
    monkeypatch.setattr(toxicity, "STEPS", 20)
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(["ab", "cd", "ef", "zorkle" if i % 4 == 0 else "gh"], k=12)), "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = [(i, int(i % 4 == 0)) for i in range(400)]
    others = [(i, i % 2) for i in range(1000, 3000)]
    a, b = (toxicity.fit(docs.union(docs.limit(20)), spark.createDataFrame(labels, "doc_id long, toxic int")) for labels in (own, own + others))
    assert (a.table == b.table).all() and (a.scale, a.offset, a.thresholds) == (b.scale, b.offset, b.thresholds)


def test_toxicity_equals_plain_filters(texts):
    """Scores against loops over places, filters and words."""
    import pyarrow as pa
    rng = np.random.default_rng(0)
    net = toxicity.Trainer(pa.array([t for _, t, _ in texts[:20]]), np.arange(20) % 2).net
    net.table[:] = rng.normal(0, 0.3, net.table.shape)
    net.weights, net.bias, net.scale, net.offset = rng.random(len(net.weights)), -0.2, 1.3, 0.1
    sample = ["", "one", "two words", *(t[:600] for _, t, _ in texts[:8])]
    got = net.scores(net.logits(common.Words(pa.array(sample))))
    for text, score in zip(sample, got):
        vectors = [np.array(toxicity.embedded(pa.array([w]), net.table)[0], np.float64) for w in words(text)] or [np.zeros(toxicity.WIDTH)]
        vectors += [np.zeros(toxicity.WIDTH)] * toxicity.PAD
        best = []
        for span, weight, shift in zip(toxicity.SPANS, net.filters, net.shifts):
            at = [sum(vectors[i + j] @ weight[j] for j in range(span)) + shift for i in range(len(vectors) - toxicity.PAD)]
            best.append(np.maximum(np.max(at, axis=0), 0))
        logit = np.concatenate(best) @ net.weights + net.bias
        assert score == pytest.approx(1 / (1 + math.exp(-(1.3 * logit + 0.1))), abs=1e-4)


def test_filters_do_not_cross_texts():
    import pyarrow as pa
    net = toxicity.Trainer(pa.array(["alpha beta gamma delta"] * 4), np.array([0, 1, 0, 1])).net
    alone = [net.logits(common.Words(pa.array([t])))[0] for t in ("alpha beta", "", "gamma delta")]
    assert np.allclose(net.logits(common.Words(pa.array(["alpha beta", "", "gamma delta"]))), alone)


def test_languages_of_held_out_texts(spark, texts, odd, nothing):
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    fold = common.in_fold(F.col("doc_id"), 5, 0)
    prototypes = langid.fit(frame.where(~fold))
    held = langid.identify(frame.where(fold), prototypes).collect()
    want = {i: lang for i, _, lang in texts}
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.95 * len(held)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(odd, prototypes).collect()}
    assert {(None, "und"), (1, "und"), (2, "und"), (3, "und")} <= got and all(lang != "und" for i, lang in got if i and i > 3)
    assert langid.fit(nothing) == {} and {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}


def test_bound_runs_are_nearly_orthogonal():
    _, code, letters, _ = langid.runs(["the quick brown fox", None])
    v = langid.run_vectors(letters)
    cosines = v @ v.T / langid.DIMENSIONS
    assert (np.diag(cosines) == 1).all() and np.abs(cosines - np.eye(len(v))).max() < 0.3


# ---- licences and benchmark passages


def test_licences(spark, odd, nothing):
    bsd = [licenses.SENTENCES[k] for k in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse")]
    rows = [
        (1, "Text.\nLicensed under the Apache License, Version 2.0.\nMore", "Apache-2.0", "permissive"),
        (2, "RELEASED UNDER THE MIT LICENSE", "MIT", "permissive"),
        (3, ":\n".join(bsd).replace(" the ", "\nthe "), "BSD-3-Clause", "permissive"),
        (4, ". ".join(bsd[:3]), "BSD-2-Clause", "permissive"),
        (5, ". ".join(reversed(bsd)), "", None),
        (6, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC-4.0,MIT", "noncommercial"),
        (7, "It is not released under the MIT License", "", None),
    ]
    got = {r.doc_id: (r.licenses, r.kind) for r in licenses.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert got == {i: (n, k) for i, _, n, k in rows}
    assert licenses.scan(odd).where("licenses <> ''").count() == 0 and licenses.scan(nothing).collect() == []


def test_every_licence_sentence_and_rule_is_found_in_its_own_text(spark):
    marks = ["", "# ", "// ", " * ", "-- ", ";; "]
    texts = {}
    for name, sentence in licenses.SENTENCES.items():
        for mark in marks:
            texts[f"{mark}{sentence}"] = name
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {list(texts)[r.doc_id]: r.sentence_ids for r in got} == texts
    rules = []
    for licence, names, kind in licenses.RULES:
        for mark in marks:
            for width in (45, 10_000):
                blank = f"\n{mark.rstrip()}\n"
                lines = blank.join("\n".join(mark + w for w in textwrap.wrap(licenses.SENTENCES[n] + ".", width, break_on_hyphens=False)) for n in names)
                rules.append((f"{mark}Title{blank}{lines}{blank}{mark}More text.", licence, kind))
    got = licenses.scan(spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(rules)], "doc_id long, text string")).collect()
    assert [(rules[r.doc_id][0], r.licenses, r.kind) for r in got if (r.licenses, r.kind) != rules[r.doc_id][1:]] == []
    apart = ["SPDX-License-Identifier: see below. MIT", "MIT: SPDX-License-Identifier", "Our SPDX-License-Identifier: MIT", "SPDX-License-Identifier: MIT License"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string")).collect()
    assert [(r.sentence_ids, r.licenses) for r in sorted(got)] == [("", "")] * 3 + [("mit.title", "")]


def test_passages_of_the_benchmark(spark, odd, nothing):
    item = "A train leaves the old station with 120 passengers and travels 45 km while 120 people wait for Maria there."
    other = "Nothing of this long and plain sentence is ever repeated in another text."
    docs = [
        (1, "Before it. " + item + " After it."), (2, "x " + item.upper()), (3, item.replace("120", "300").replace("45", "8").replace("Maria", "Peter")),
        (4, item.replace("120", "300", 1).replace("45", "8")), (5, "A train leaves the old station"), (6, "unrelated words " * 40), (7, other.replace(" ", "  \n")),
    ]
    bench = spark.createDataFrame([(10, item), (11, other), (12, None), (13, "short"), (11, other)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 10): True, (2, 10): True, (3, 10): False, (7, 11): True}
    assert decontaminate.contaminated(odd, bench).collect() == [] and decontaminate.contaminated(nothing, bench).collect() == []
    assert decontaminate.contaminated(odd, bench.limit(0)).collect() == []


def leaks(spark, docs, items):
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.windows, r.exact) for r in decontaminate.contaminated(*frames).collect()}


def test_one_changed_value_does_not_clear_a_passage(spark):
    filler = [f"plain{k}" for k in range(36)]
    item = " ".join(["take", "2", "sacks", "of", "flour", *filler[:18], "and", "2", "loaves", *filler[18:], "home"])
    named = "we asked Maria about the long way to the harbour and the old mill before noon and then Maria told us all of it again"
    docs = [
        (1, item), (2, item.replace("2 loaves", "3 loaves")), (3, named.replace("Maria told", "Peter told")),
        (4, named.replace("Maria", "Peter")), (4, named.replace("Maria", "Paula")), (None, item.replace(" 2 ", " 4 ")), (None, item.replace(" 2 ", " 5 ")), (None, "nothing of it"),
    ]
    got = leaks(spark, docs, [(10, item), (11, named)])
    n, m = len(item.split()) - 7, len(named.split()) - 7
    assert set(got) == {(1, 10), (2, 10), (3, 11), (4, 11), (None, 10)}
    assert got[1, 10] == (n, True) and got[4, 11] == (m, False) and got[None, 10] == (n, False)
    without = lambda text, v: sum(v not in text.split()[k:k + 8] for k in range(len(text.split()) - 7))
    assert got[2, 10] == (without(item, "2"), False) and got[3, 11][0] >= without(named, "Maria") > 0
    two = leaks(spark, [(1, named)], [(11, named.replace("Maria", "Peter")), (11, named.replace("Maria", "Paula"))])
    assert two == {(1, 11): (m, False)}


def test_names_at_the_start_of_sentences_and_beyond_a_to_z(spark):
    item = "Tom has 5 apples. Tom buys 3 more apples. Tom eats 2 apples. Tom now has how many apples?"
    accents = "in the little town by the sea we met José and gave {} a book about the stars"
    both = "the old ship left the harbour and Maria waved. Then the rain began and the gulls flew home."
    docs = [
        (1, item), (2, item.replace("Tom", "Anna")), (3, item.replace("Tom", "Łukasz")), (4, "So " + item.replace("Tom", "Émile")),
        (5, "Anna has 5 apples. Peter buys 3 more apples. Émile eats 2 apples. Maria now has how many apples?"),
        (6, accents.format("Łukasz").replace("José", "Émile")), (7, both.replace("Then", "Soon").replace("Maria", "Zoë")),
    ]
    got = leaks(spark, docs, [(10, item), (11, accents.format("Tom")), (12, both)])
    n, m = len(item.split()) - 7, len(accents.split()) - 7
    assert got == {(1, 10): (n, True), (2, 10): (n, False), (3, 10): (n, False), (4, 10): (n, False), (6, 11): (m, False), (7, 12): (len(both.split()) - 7, False)}


def test_short_items_and_tables_of_numbers_are_found(spark):
    sums = "12 + 15 = 27 and 14 + 18 = 32 and 21 + 22 = 43 and 9 + 8 = 17"
    figures = "1 2 3 5 8 13 21 34 55 89 144"
    items = [(1, sums), (2, figures), (3, "Paris"), (4, "What is 7 km in miles?"), (5, "the sum of two odd numbers is"), (6, " ?! "), (7, None)]
    docs = [
        (1, f"See: {sums}, so."), (2, sums.replace("27", "28")), (3, f"x {figures} y"), (4, "2 3 4 6 9 14 22 35 56 90 145"), (5, "They met in PARIS."), (6, "Parisian"),
        (7, "Again, what is 7 km in miles"), (8, "what is 8 km in miles"), (9, "The sum of two odd numbers is even."), (10, "the sum of two even numbers is"), (11, "paris"), (12, ""), (13, None),
    ]
    got = leaks(spark, docs, items)
    n, m = 15 - 7, 11 - 7
    assert got == {(1, 1): (n, True), (2, 1): (5, True), (3, 2): (m, True), (5, 3): (1, True), (7, 4): (1, True), (8, 4): (1, False), (9, 5): (1, True), (11, 3): (1, True)}


# ---- archives


def test_archives_come_back(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "u\r\nInjected: x", "é\r\n\r\nWARC/1.1 body"), (5, "u", None), (6, "u", ""), (None, "u", "same"), (7, "u", "x" * 300_000), (2, "http://a/2", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    folder, index = warc.write_archives(pages)
    got = sorted(warc.read_records(folder, index).collect(), key=lambda r: (r.page_id or 0, r.record_type))
    want = []
    for i, url, html in rows:
        payload = (html or "").encode()
        largest = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        kind = "response" if i == largest else "revisit"
        want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), kind, None if i == largest else largest, (html or "") if i == largest else None))
    assert [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.html) for r in got] == sorted(want, key=lambda r: (r[0] or 0, r[3]))
    some = warc.read_records(folder, index.where("page_id in (4, 7)")).collect()
    assert {(r.page_id, r.url) for r in some} == {(4, "u  Injected: x"), (7, "u")}
    assert warc.read_records(*warc.write_archives(pages.limit(0))).collect() == []
    small, index = warc.write_archives(pages, min_bytes=100)
    assert index.where("record_type = 'revisit'").count() == 0


def test_reads_are_coalesced():
    assert warc.coalesced([(0, 10), (10, 5), (15 + warc.GAP + 1, 4)]) == [(0, 15, 0, 2), (15 + warc.GAP + 1, 19 + warc.GAP + 1, 2, 3)]


# ---- vectors


def test_linked_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(700, 24))
    near = base[0] + 0.04 * rng.normal(size=(600, 24)) * np.linalg.norm(base[0]) / np.sqrt(24)    # longer than a block
    chain = np.stack([np.cos(a) * base[1] / np.linalg.norm(base[1]) + np.sin(a) * np.eye(24)[0] for a in np.linspace(0, 1, 12)])
    x = np.concatenate([base, near, chain, base[2:5] * 7, base[[6, 6, 6]]])
    rows = [(int(k), [float(v) for v in r]) for k, r in enumerate(x)]
    odd = [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [1.0] * 23 + [None]), (9004, [float("nan")] + [1.0] * 23), (9005, [float("inf")] * 24),
           (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, [-2.0, 4.0]), (9008, [-2.0, 4.0])]
    got = pivot_index.linked_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("entry", F.lit("clash"))).collect()
    assert len(got) == len(rows) + len(odd)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    want = np.arange(len(x))
    for _ in range(40):
        want = np.where(linked, want[None], len(x)).min(axis=1)
    by_id = {r.vec_id: r for r in got}
    ours, exact = sum(by_id[k].n_links for k in range(len(x))), int(linked.sum()) - len(x)
    assert 0.98 * exact <= ours <= exact
    assert sum(by_id[k].component_id == want[k] for k in range(len(x))) >= 0.99 * len(x)
    assert all(by_id[k].n_links == 0 and by_id[k].component_id == k and by_id[k].kept for k in range(9000, 9006))
    assert [(by_id[k].n_links, by_id[k].component_id) for k in (9006, 9007, 9008)] == [(1, 9006), (1, 9006), (1, 9008)]


def test_no_usable_vector(spark):
    frame = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in pivot_index.linked_vectors(frame).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}
    assert pivot_index.linked_vectors(frame.limit(0)).collect() == []


# ---- registered queries


def test_registered_queries():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    from check_queries import compare

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    state, note, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER)
    assert state == "ok", note
