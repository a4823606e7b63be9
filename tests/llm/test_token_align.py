"""Alignment against a plain walk over both token sequences."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import public_tokenizers

from sievework.llm import token_align

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LINKED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spans(ids, tokens):
    at, out = 0, []
    for k in ids:
        out.append((at, at + len(tokens[k]), k))
        at += len(tokens[k])
    return out


def expected(docs):
    a, b = token_align.ByteLevel(A), token_align.Pieces(B)
    held, counts = [], Counter()
    for i, text in docs:
        sides = []
        if text:
            want = (" " + text).encode()
            lists = a.library.encode(" " + text, add_special_tokens=False).ids, b.library.encode(text)
            if all(b"".join(x.tokens[k] for k in own) == want for own, x in zip(lists, (a, b))):
                sides = [spans(own, x.tokens) for own, x in zip(lists, (a, b))]
        if not sides:
            held.append((i, 0, 0, 0, [], ""))
            continue
        cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(k) for s, e, k in side if start <= s and e <= cut) for side in sides))
            start = cut
        ends = defaultdict(list)
        for _, e, y in sides[1]:
            ends[e].append(y)
        links = [(x, y) for _, e, x in sides[0] for y in ends[e]]
        counts.update(links)
        held.append((i, len(sides[0]), len(sides[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = [(i, na, nb, g, len(links), sum(counts[x, y] == top[y] for x, y in links), sum(counts[p] for p in links), sha) for i, na, nb, g, links, sha in held]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in token_align.alignments(frame, A, B).select(*LINKED).collect()), key=repr)


def test_documents_equal_brute_force(spark):
    docs = [(i, t) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall() if len(t) < 3000]
    rng = random.Random(2)
    letters = [" ", " ", "\n", "\t", *"abdeinth.,!'$&é", "日本", "🙂", "\x00", "<s>", "<0x41>", "0x1F", "<|endoftext|>", "▁", "́", "12"]
    docs += [(10_000 + k, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))) for k in range(400)]
    want = expected(docs)
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == want
    assert any(r[1] == 0 for r in want) and any(r[3] < r[1] for r in want)


def test_rare_pairs_are_joined(spark, monkeypatch):
    docs = [(k, t) for k, t in enumerate(["the cat sat", "the dog sat on the mat", "a unique sentence, tokenised", "the cat"] * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for share in (1, 20, 10_000):      # none, some, all pairs are hot
        monkeypatch.setattr(token_align, "HOT_SHARE", share)
        assert found(frame) == expected(docs)


def test_odd_rows(spark):
    docs = [(None, None), (None, "null id"), (1, ""), (2, "x"), (2, "x"), (2, "another text of the id"), (3, " "), (4, "  two  blanks "), (5, "▁ a"), (6, "日本語🙂 é\x00"), (7, "word " * 500)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, many string")
    assert found(frame) == expected(docs)
    assert found(frame.limit(0)) == []


def test_long_text_without_blanks(spark):
    text = "".join(random.Random(4).choice("abcdefgh日") for _ in range(400_000))
    row = token_align.alignments(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    assert row.n_a > 0 and row.n_links == row.n_groups and row.n_overlaps >= max(row.n_a, row.n_b)
