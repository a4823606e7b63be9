"""An interpolated modified Kneser-Ney bigram model of a corpus, in memory-mapped sorted hash arrays.

Counting runs in Spark. Word counts are an aggregate over word hashes; sorted by hash they give every
word an id, its place. Word pairs are packed as ``id * V + id`` and mixed by a bijection, counted
within a task, and merged by ranges of the mixed value, so that frequent words spread like any other.
Each range is written once, sorted, to a folder that all executors mount; tasks map it into memory
and find their pairs by binary search. The number of ranges follows the corpus, so no task and no
file grows with it.

The end of a text is a word, and it is also what stands before the first word of the next.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import MIX_1, MIX_2, U64, Words, blocks, hash_strings, mix, mounted, on_tables, scratch, signed, stored

PER_FILE = 1 << 20              # entries of a range, about
END = U64(0x1D8AF066F5B1C3E7)   # stands for the end of a text
BASE_ADD = 0.1                  # added to every count of the unigram baseline
USUAL = (0.5, 1.0, 1.5)         # discounts where the counts of counts give none


def inverse(odd: U64) -> U64:
    """The multiplier that undoes ``odd``, by Newton's steps."""
    x = int(odd)
    y = x
    for _ in range(6):
        y = y * (2 - x * y) % (1 << 64)
    return U64(y)


UNMIX_1, UNMIX_2 = inverse(MIX_1), inverse(MIX_2)


def unmix(x: np.ndarray) -> np.ndarray:
    """What :func:`mix` has mixed."""
    x = (x ^ (x >> U64(31)) ^ (x >> U64(62))) * UNMIX_2
    x = (x ^ (x >> U64(27)) ^ (x >> U64(54))) * UNMIX_1
    return x ^ (x >> U64(30)) ^ (x >> U64(60))


def bits_for(entries: int) -> int:
    return max(1, (max(entries, 1) // PER_FILE).bit_length())


def split_points(values: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of the top ``bits`` begins in sorted ``values``, and the end."""
    edges = np.arange(1 << bits, dtype=U64) << U64(64 - bits)
    return np.append(np.searchsorted(values, edges), len(values))


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array with those of equal weight together, which compress better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def put(path: str, values: np.ndarray) -> None:
    """Write an array under a name of the attempt, then move it; a task that runs again replaces it."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        np.save(f, values)
    os.replace(own, path)


def narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


@dataclass(frozen=True)
class Places:
    """Sorted ranges of hashes under one name in the model's folder."""

    folder: str
    name: str
    bits: int
    sizes: tuple[int, ...]

    def load(self, part: int, what: str) -> np.ndarray:
        return np.load(f"{self.folder}/{self.name}-{part:06d}.{what}.npy", mmap_mode="r")

    def find(self, hashes: np.ndarray, wanted: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The places of sorted ``hashes`` (-1 if there are none), and the wanted values there."""
        place = np.full(len(hashes), -1, np.int64)
        values = [np.zeros(len(hashes), np.int64) for _ in wanted]
        points = split_points(hashes, self.bits)
        base = 0
        for part, size in enumerate(self.sizes):
            a, b = points[part], points[part + 1]
            if size and b > a:
                held = self.load(part, "hash")
                at = np.minimum(np.searchsorted(held, hashes[a:b]), size - 1)
                found = np.flatnonzero(held[at] == hashes[a:b])
                place[a + found] = base + at[found]
                for out, what in zip(values, wanted):
                    out[a + found] = self.load(part, what)[at[found]]
            base += size
        return place, values


def token_stream(words: Words) -> np.ndarray:
    """Word codes of the block, each text followed by the end (code ``len(vocabulary)``)."""
    n = len(words.codes) + len(words)
    out = np.full(n, len(words.vocabulary), np.int64)
    out[np.arange(len(words.codes)) + words.owners()] = words.codes
    return out


def vocabulary_hashes(words: Words) -> np.ndarray:
    return np.append(hash_strings(words.vocabulary), END)


def word_counts(batches):
    for batch in blocks(batches):
        words = Words(batch.column("text"))
        counts = np.bincount(token_stream(words), minlength=len(words.vocabulary) + 1)
        yield pa.RecordBatch.from_arrays([signed(vocabulary_hashes(words)), pa.array(counts)], names=["hash", "n"])


def write_words(group: pa.Table, folder: str) -> pa.Table:
    """One range of word hashes and counts."""
    part = group.column("part")[0].as_py()
    hashes = group.column("hash").to_numpy().view(U64)
    order = np.argsort(hashes)
    put(f"{folder}/word-{part:06d}.hash.npy", hashes[order])
    put(f"{folder}/word-{part:06d}.count.npy", group.column("n").to_numpy()[order])
    return pa.table({"part": pa.array([part], pa.int32()), "size": pa.array([len(hashes)], pa.int64())})


def find_words(places: Places, words: Words, wanted: tuple[str, ...]):
    """Ids and values of the vocabulary and the end."""
    hashes = vocabulary_hashes(words)
    order = np.argsort(hashes)
    ids, values = places.find(hashes[order], wanted)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return ids[back], [v[back] for v in values]


def mixed_pairs(ids: np.ndarray, stream: np.ndarray, before: np.ndarray, size: int) -> np.ndarray:
    return mix(ids[before].astype(U64) * U64(size) + ids[stream].astype(U64))


def preceding(words: Words, stream: np.ndarray) -> np.ndarray:
    return np.append(len(words.vocabulary), stream[:-1])


def pair_counts(batches, places: Places, bits: int):
    """Counted word pairs of each block, one row for each range that has any."""
    size = sum(places.sizes)
    for batch in blocks(batches):
        words = Words(batch.column("text"))
        ids, _ = find_words(places, words, ())
        stream = token_stream(words)
        pairs, counts = np.unique(mixed_pairs(ids, stream, preceding(words, stream), size), return_counts=True)
        points = split_points(pairs, bits)
        rows = [(part, pack(np.diff(pairs[a:b], prepend=U64(0))), pack(counts[a:b].astype(np.uint32)))
                for part, (a, b) in enumerate(zip(points[:-1], points[1:])) if b > a]
        parts, hashes, numbers = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(hashes, pa.binary()), pa.array(numbers, pa.binary())], names=["part", "pairs", "counts"])


def write_pairs(group: pa.Table, places: Places) -> pa.Table:
    """Merge and write one range of pairs; give what it adds to the statistics of words, by their range."""
    part = group.column("part")[0].as_py()
    pairs = np.concatenate([np.cumsum(unpack(x.as_py(), U64), dtype=U64) for x in group.column("pairs")])
    counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in group.column("counts")]).astype(np.int64)
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    pairs, counts = pairs[starts], np.add.reduceat(counts, starts)
    put(f"{places.folder}/pair-{part:06d}.hash.npy", pairs)
    put(f"{places.folder}/pair-{part:06d}.count.npy", narrow(counts))
    size = sum(places.sizes)
    plain = unmix(pairs)
    first, second = (plain // U64(size)).astype(np.int64), (plain % U64(size)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(places.sizes)])
    rows = []
    for kind, ids in (("first", first), ("second", second)):
        known, at = np.unique(ids, return_inverse=True)
        if kind == "first":
            numbers = [np.bincount(at[mask], minlength=len(known)) for mask in (counts == 1, counts == 2, counts > 2)]
        else:
            numbers = [np.bincount(at, minlength=len(known))]
        edges = np.searchsorted(known, base)
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b > a:
                rows.append((k, part, len(pairs), kind, pack((known[a:b] - base[k]).astype(np.uint32)), [pack(x[a:b].astype(np.uint32)) for x in numbers], None))
    rows.append((0, part, len(pairs), "sizes", b"", [], [int((counts == k).sum()) for k in (1, 2, 3, 4)]))
    columns = list(zip(*rows))
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word_part", "part", "size", "kind", "ids", "numbers", "of_counts"])


STATISTICS = "word_part int, part int, size long, kind string, ids binary, numbers array<binary>, of_counts array<long>"


def write_statistics(group: pa.Table, places: Places) -> pa.Table:
    """Per word of one range: how many words follow it once, twice, more often; how many precede it."""
    part = group.column("word_part")[0].as_py()
    out = {k: np.zeros(places.sizes[part], np.int64) for k in ("once", "twice", "more", "preceded")}
    sizes, of_counts = {}, np.zeros(4, np.int64)
    for row in group.to_batches():
        for kind, ids, numbers, own, size, of in zip(*(row.column(c) for c in ("kind", "ids", "numbers", "part", "size", "of_counts"))):
            if kind.as_py() == "sizes":
                sizes[own.as_py()] = size.as_py()
                of_counts += np.array(of.as_py())
                continue
            at = unpack(ids.as_py(), np.uint32)
            for name, data in zip(("once", "twice", "more") if kind.as_py() == "first" else ("preceded",), numbers.as_py()):
                out[name][at] += unpack(data, np.uint32)
    for name, values in out.items():
        put(f"{places.folder}/word-{part:06d}.{name}.npy", narrow(values))
    preceded = out["preceded"]
    own = [int((preceded == k).sum()) for k in (1, 2, 3, 4)] + [int((preceded > 2).sum()), int(preceded.sum())]
    return pa.table({"parts": pa.array([list(sizes)], pa.list_(pa.int32())), "sizes": pa.array([list(sizes.values())], pa.list_(pa.int64())),
                     "of_counts": pa.array([of_counts.tolist()], pa.list_(pa.int64())), "preceded": pa.array([own], pa.list_(pa.int64()))})


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more; the usual values where counts of counts give none."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [k - (k + 1) * y * b / a if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0] + [d if 0 < d < k else usual for k, (d, usual) in enumerate(zip(found, USUAL), 1)])


@dataclass(frozen=True)
class Model:
    words: Places
    pairs: Places | None
    tokens: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    preceded: int          # distinct pairs
    floor: float           # share of unseen words at the lower order

    @property
    def size(self) -> int:
        return sum(self.words.sizes)


def fit(documents: DataFrame) -> Model:
    """Count the column ``text`` of ``documents`` and write the model to the shared folder.

    Null and empty texts count as an end alone. Without rows the model knows no word and gives
    every token the probability 1.
    """
    spark = documents.sparkSession
    texts = documents.select("text")
    folder = mounted(scratch(spark, "ngrams"))
    os.makedirs(folder)
    counts = stored(texts.mapInArrow(word_counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "words")
    size, tokens = counts.agg(F.count("*"), F.sum("n")).first()
    if not size:
        return Model(Places(folder, "word", 1, (0, 0)), None, 0, discounts(0, 0, 0, 0), discounts(0, 0, 0, 0), 0, 1.0)
    if size >= 1 << 32:
        raise ValueError("word ids have 32 bits")
    bits = bits_for(size)
    ranged = counts.withColumn("part", F.shiftrightunsigned("hash", 64 - bits).cast("int"))
    rows = ranged.groupBy("part").applyInArrow(on_tables(write_words, folder=folder), "part int, size long").collect()
    held = dict(map(tuple, rows))
    words = Places(folder, "word", bits, tuple(held.get(k, 0) for k in range(1 << bits)))
    pair_bits = bits_for(tokens)
    pairs = texts.mapInArrow(partial(pair_counts, places=words, bits=pair_bits), "part int, pairs binary, counts binary")
    added = pairs.groupBy("part").applyInArrow(on_tables(write_pairs, places=words), STATISTICS)
    rows = added.groupBy("word_part").applyInArrow(
        on_tables(write_statistics, places=words), "parts array<int>, sizes array<long>, of_counts array<long>, preceded array<long>").collect()
    held = {p: n for r in rows for p, n in zip(r["parts"], r["sizes"])}
    of_counts = np.sum([r["of_counts"] for r in rows], axis=0)
    k1, k2, k3, k4, more, preceded = np.sum([r["preceded"] for r in rows], axis=0).tolist()
    word_discounts = discounts(k1, k2, k3, k4)
    return Model(words, Places(folder, "pair", pair_bits, tuple(held.get(k, 0) for k in range(1 << pair_bits))), tokens,
                 discounts(*of_counts.tolist()), word_discounts, preceded, float(word_discounts[1:] @ [k1, k2, more]) / preceded)


def scored(batches, model: Model):
    size = model.size
    for batch in blocks(batches):
        words = Words(batch.column("text"))
        stream = token_stream(words)
        before = preceding(words, stream)
        ids, (count, once, twice, more, preceded) = find_words(model.words, words, ("count", "once", "twice", "more", "preceded")) \
            if size else (np.full(len(words.vocabulary) + 1, -1), [np.zeros(len(words.vocabulary) + 1, np.int64)] * 5)
        known = ids >= 0
        low = model.floor / (size + 1) + (preceded - model.word_discounts[np.minimum(preceded, 3)]) / max(model.preceded, 1)
        left = np.where(known, (model.pair_discounts[1:] @ np.stack([once, twice, more])) / np.maximum(count, 1), 1.0)
        p = left[before] * low[stream]
        both = np.flatnonzero(known[before] & known[stream])
        if len(both):
            pairs, at = np.unique(mixed_pairs(ids, stream[both], before[both], size), return_inverse=True)
            _, (seen,) = model.pairs.find(pairs, ("count",))
            seen = seen[at]
            p[both] += (seen - model.pair_discounts[np.minimum(seen, 3)]) / count[before[both]]
        base = np.log10((count + BASE_ADD) / (model.tokens + BASE_ADD * (size + 1)))
        starts = words.bounds[:-1] + np.arange(len(words))
        n_tokens = np.diff(words.bounds) + 1
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(n_tokens), pa.array(np.add.reduceat(known[stream].astype(np.int64), starts)),
             pa.array(np.full(len(words), model.tokens)), pa.array(np.add.reduceat(base[stream], starts)), pa.array(np.add.reduceat(np.log10(p), starts))],
            names=[*(c for c in batch.schema.names if c != "text"), "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` without ``text``, with n_tokens, n_known, train_tokens, base_score and score.

    ``score`` is the model's log10 probability of the text and its end, ``base_score`` that of the
    unigram baseline. Perplexity is ``10 ** (-score / n_tokens)``. Columns of these names are replaced.
    """
    added = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    documents = documents.drop(*added)
    fields = [f for f in documents.schema.fields if f.name != "text"]
    schema = T.StructType(fields + [T.StructField(k, v) for k, v in added.items()])
    return documents.mapInArrow(partial(scored, model=model), schema)
