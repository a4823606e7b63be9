"""Alignment of the tokens of two tokenizers by interval coalescing.

A text with a blank in front is cut before every blank that follows another character. Where neither
tokenizer joins what such a cut parts, each distinct stretch is encoded and aligned once a block of
texts; otherwise a stretch is a whole text. Both encode the same bytes, so their tokens are intervals over one
line, on which the stretches lie behind each other. All tokens are sorted by start, ``maximum.accumulate`` runs over their ends, and a group ends
where the next start reaches the running maximum. Within a group every token is paired with those of the
other tokenizer that it overlaps. Pairs that end together are links; how often an id pair is linked is
counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import blocks, stored, string_parts, whole

BLOCK_BYTES = 4 << 20           # texts that a task aligns at once, or one text
BATCH, BATCH_BYTES = 16_000, 1 << 18   # stretches that are encoded and aligned at once, and their bytes, or one stretch
HOT_SHARE = 10_000              # pairs with more than one in so many links are counted as hot; there are fewer of them than this
MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow in order from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level vocabulary (.json) with its library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        letters = byte_letters()
        self.tokens = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for piece, id_ in self.library.get_vocab(with_added_tokens=True).items():
            known = all(c in letters for c in piece)
            self.tokens[id_] = bytes(letters[c] for c in piece) if known else piece.encode()
        # Its words begin at a blank, whatever stands before it, if it splits by the usual pattern.
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        splits = parts.get("pre_tokenizer") or {}
        self.cuts = parts.get("normalizer") is None and splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")

    def encode(self, stretches: list[str]) -> list:
        """Ids of texts that begin with a blank."""
        return [e.ids for e in self.library.encode_batch_fast(stretches, add_special_tokens=False)]


class Pieces:
    """A model of pieces (.model) with its library; it puts a blank in front of a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spell = lambda k: bytes([int(self.library.id_to_piece(k)[3:5], 16)]) if self.library.is_byte(k) else self.library.id_to_piece(k).replace(MARK, " ").encode()
        self.tokens = [spell(k) for k in range(self.library.get_piece_size())]
        # No piece reaches over a blank, and blanks are kept as they are.
        inner = any(MARK in self.library.id_to_piece(k).lstrip(MARK) for k in range(len(self.tokens)))
        probe = "a  b c   "
        self.cuts = not inner and b"".join(self.tokens[k] for k in self.library.encode(probe)) == (" " + probe).encode()

    def encode(self, stretches: list[str]) -> list:
        return self.library.encode([x[1:] for x in stretches], num_threads=1)


def tokenizer(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


class Side:
    """Tokens of one tokenizer over stretches: ids, start and end of each, and the stretch they belong to."""

    def __init__(self, lists: list, lengths: np.ndarray, kept: np.ndarray, bases: np.ndarray):
        lists = [own if keep else () for own, keep in zip(lists, kept)]
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ids = np.fromiter(chain.from_iterable(lists), np.int64, int(self.sizes.sum()))
        ends = np.cumsum(lengths[self.ids])
        first = np.cumsum(self.sizes) - self.sizes
        before = np.append(0, ends)[first]
        self.owner = np.repeat(np.arange(len(lists)), self.sizes)
        self.ends = ends - before[self.owner] + bases[self.owner]
        self.starts = self.ends - lengths[self.ids]


def coalesced(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all tokens (those of ``a`` first) by group, side and place, with the side and group of each."""
    starts, ends = np.concatenate([a.starts, b.starts]), np.concatenate([a.ends, b.ends])
    side = np.repeat([0, 1], [len(a.ids), len(b.ids)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.cumsum(np.append(True, starts[order][1:] >= reach[:-1])[:len(order)]) - 1
    within = np.lexsort((starts[order], side[order], group))
    return order[within], side[order][within], group[within]


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens of ``a`` and ``b`` that share a byte."""
    first = np.searchsorted(b.ends, a.starts, "right")
    last = np.searchsorted(b.starts, a.ends, "left")
    many = np.maximum(last - first, 0)
    left = np.repeat(np.arange(len(a.ids)), many)
    right = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return left, right


def spelled(lists: list, tokens: list[bytes], texts: list[bytes]) -> np.ndarray:
    """Whether the tokens of each text give its bytes."""
    return np.array([b"".join([tokens[k] for k in own]) == text for own, text in zip(lists, texts)], bool)


class Names:
    """Decimal ids, each with one of the marks behind it that stand between ids and groups."""

    MARKS = ("", ";", ",", "|")

    def __init__(self, most: int):
        self.most = most
        self.names = np.array([f"{k}{mark}" for mark in self.MARKS for k in range(most)], object)

    def groups(self, order, side, group, a: Side, b: Side) -> np.ndarray:
        """``a1,a2|b1;a3|b2,b3`` for each stretch."""
        ids, owner = np.concatenate([a.ids, b.ids])[order], np.concatenate([a.owner, b.owner])[order]
        same_group = np.append(group[1:] == group[:-1], False)
        same_stretch = np.append(owner[1:] == owner[:-1], False)
        same_side = np.append(side[1:] == side[:-1], False)
        mark = np.where(~same_stretch, 0, np.where(~same_group, 1, np.where(same_side, 2, 3)))
        words = self.names[mark * self.most + ids].tolist()
        ends = np.searchsorted(owner, np.arange(len(a.sizes) + 1)).tolist()
        out = np.empty(len(a.sizes), object)
        out[:] = ["".join(words[x:y]) for x, y in zip(ends[:-1], ends[1:])]
        return out


def stretches(texts: pa.Array, cut: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct stretches of texts with a blank in front, which of them each text has, and the bounds of each text.

    A null or empty text has none.
    """
    texts = texts.filter(pc.greater(pc.binary_length(texts), 0))
    data, bounds = string_parts(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    begins = bounds[:-1]
    if cut and len(data):
        blank = data == 32
        starts = blank & np.append(True, ~blank[:-1])
        starts[bounds[1:] - 1] = False     # a blank at the very end stays with what is before it
        starts[begins] = True
        begins = np.flatnonzero(starts)
    offsets = np.append(begins, len(data)).astype(np.int64)
    every = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = every.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(begins, bounds)


class Aligner:
    """Two tokenizers, and what aligning needs of their vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.both = tokenizer(path_a), tokenizer(path_b)
        self.sizes = [np.array([len(t) for t in x.tokens], np.int64) for x in self.both]
        self.names = Names(max(map(len, self.sizes)))
        self.cuts = all(x.cuts for x in self.both)

    def align(self, words: list[str]) -> dict[str, np.ndarray]:
        """Per stretch: counts, whether both tokenizers give it back, its groups; and the linked ids, in order of stretch."""
        n = len(words)
        expected = [w.encode() for w in words]
        lists = [x.encode(words) for x in self.both]
        right = spelled(lists[0], self.both[0].tokens, expected) & spelled(lists[1], self.both[1].tokens, expected)
        lengths = np.array([len(w) for w in expected], np.int64)
        a, b = (Side(own, size, right, np.cumsum(lengths) - lengths) for own, size in zip(lists, self.sizes))
        order, side, group = coalesced(a, b)
        left, other = overlaps(a, b)
        shared = np.bincount(a.owner[left], minlength=n)
        together = a.ends[left] == b.ends[other]
        left, other = left[together], other[together]
        owner = np.concatenate([a.owner, b.owner])[order]
        groups = np.bincount(owner[np.append(True, group[1:] != group[:-1])[:len(group)]], minlength=n)
        return {"right": right, "a": a.sizes, "b": b.sizes, "groups": groups, "shared": shared, "spelt": self.names.groups(order, side, group, a, b),
                "links": np.bincount(a.owner[left], minlength=n), "pairs": a.ids[left] * self.names.most + b.ids[other]}


@lru_cache(1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One aligner for all tasks of a worker; loading one in each task leaves the worker's memory in pieces."""
    return Aligner(path_a, path_b)


def aligned(batches, path_a: str, path_b: str):
    """Per text: counts, the digest of its groups, and its distinct linked id pairs with their numbers."""
    aligner = aligner_of(path_a, path_b)
    most = aligner.names.most
    for batch in blocks(batches, size=BLOCK_BYTES):
        texts = whole(batch.column("text"))
        found, codes, bounds = stretches(texts, aligner.cuts)
        full = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        n = len(texts)
        bounds = np.append(0, bounds[np.cumsum(full)])             # empty texts hold nothing
        held = np.repeat(np.arange(n), np.diff(bounds))
        # The lists of the libraries are large, so only a few stretches are in their hands at once.
        few = pa.RecordBatch.from_arrays([found], names=["stretch"])
        parts = [aligner.align(part.column("stretch").to_pylist()) for part in blocks([few], BATCH, "stretch", BATCH_BYTES)] or [aligner.align([])]
        own = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
        del parts

        # From distinct stretches to texts; a text with a stretch that is not given back has no tokens.
        kept = np.bincount(held, ~own["right"][codes], n) == 0
        codes, held = codes[kept[held]], held[kept[held]]
        count = lambda name: pa.array(np.bincount(held, own[name][codes], n).astype(np.int64))
        spelt, ends = own["spelt"][codes].tolist(), np.searchsorted(held, np.arange(n + 1)).tolist()
        digests = [hashlib.sha256(";".join(spelt[x:y]).encode()).hexdigest() if y > x else "" for x, y in zip(ends[:-1], ends[1:])]
        # Distinct pairs of each text: links of its stretches, numbered within the block.
        pairs, pair = np.unique(own["pairs"], return_inverse=True)
        links = own["links"]
        many = links[codes]
        at = np.repeat((np.cumsum(links) - links)[codes] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        keys, many = np.unique(np.repeat(held, many) * max(len(pairs), 1) + pair[at], return_counts=True)
        row, pair = np.divmod(keys, max(len(pairs), 1))
        listed = lambda x: pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(x.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(count, ("a", "b", "groups", "links", "shared")), pa.array(digests, pa.string()),
             listed(pairs[pair] // most), listed(pairs[pair] % most), listed(many)],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "a_ids", "b_ids", "many"])


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
           "a_ids array<int>, b_ids array<int>, many array<int>")


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each row of ``documents``: its tokens, groups and links, and a ``row`` number of its own.

    Texts that are null or empty, or that one of the tokenizers does not give back byte by byte behind a
    blank, have no tokens. Other columns are ignored; repeated rows and null ids keep their rows.
    """
    rows = documents.select("doc_id", "text").mapInArrow(partial(aligned, path_a=path_a, path_b=path_b), ALIGNED)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")


def linked_pairs(rows: DataFrame) -> DataFrame:
    """(row, a, b, many): the distinct id pairs that each row links."""
    pairs = F.arrays_zip(F.col("a_ids").alias("a"), F.col("b_ids").alias("b"), F.col("many").alias("many"))
    return rows.select("row", F.explode(pairs).alias("p")).select("row", "p.a", "p.b", "p.many")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, links, best): how often the corpus links each id pair, and whether no pair of its ``b`` does it more often."""
    counts = linked_pairs(rows).groupBy("a", "b").agg(F.sum("many").alias("links"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))           # one row an id
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def with_corpus_counts(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`align` with ``n_best`` and ``count_sum`` over their links.

    A pair that makes up more than one in HOT_SHARE of all links is hot. There are fewer than HOT_SHARE hot
    pairs, so they are broadcast whatever the corpus; no other pair can make a large task of the join.
    """
    counts = stored(pair_counts(rows), "pairs")
    total = rows.agg(F.coalesce(F.sum("n_links"), F.lit(0))).first()[0]
    hot = counts.where(F.col("links") * HOT_SHARE > total).select("a", "b", F.col("links").alias("hot_links"), F.col("best").alias("hot_best"))
    met = linked_pairs(rows).join(F.broadcast(hot), ["a", "b"], "left")
    sums = lambda links, best: (F.sum(F.col("many") * F.col(links)).alias("s"), F.sum(F.when(F.col(best), F.col("many")).otherwise(0)).alias("n"))
    common = met.where(F.col("hot_links").isNotNull()).groupBy("row").agg(*sums("hot_links", "hot_best"))
    rare = met.where(F.col("hot_links").isNull()).select("row", "a", "b", "many")
    rare = rare.join(counts.where(F.col("links") * HOT_SHARE <= total), ["a", "b"]).groupBy("row").agg(*sums("links", "best"))
    both = common.unionByName(rare).groupBy("row").agg(F.sum("n").alias("n_best"), F.sum("s").alias("count_sum"))
    out = rows.drop("a_ids", "b_ids", "many").join(both, "row", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}).drop("row")


def alignments(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, n_best, count_sum for each document; see :func:`align`."""
    return with_corpus_counts(align(documents, path_a, path_b))
