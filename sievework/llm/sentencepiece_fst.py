"""SentencePiece encoding and decoding as a weighted transducer.

The model is compiled into three machines: a normaliser (a space becomes the word mark, a mark goes
before the text), a trie of pieces, and byte arcs for characters without a piece. Composed with an
input they give a lattice of pieces, and the encoding is its shortest path in the tropical semiring.

For merge models the weight sits on pairs of neighbouring pieces: zero if merging the two pieces'
characters from scratch leaves just these two, infinite otherwise. A merge touches two neighbours
only, so a path of finite weight is exactly the encoding that merging gives, and there is one. The
weight of a pair is found by undoing the later merge on either side of the boundary until a merge
across it would have come first, or none is left.

Between a character and a word mark no piece crosses, so the path breaks up there, and each distinct
stretch of a block of texts is composed once.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sievework.llm.common import blocks, string_parts, whole

MARK = "▁"
# Field numbers and codes of the model file.
PIECE, TRAINER, NORMALISER = 1, 2, 3
TEXT, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
# Stretches and pair weights kept by a task; more are worked out again.
REMEMBERED, REMEMBERED_PAIRS = 200_000, 600_000


def fields(data: bytes):
    """(number, value) of an encoded message; numbers as ints, the rest as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[at:at + size]
            at += size


class Transducer:
    """A compiled model: ``encode`` a normalised stretch, ``decode`` ids."""

    def __init__(self, data: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in fields(data):
            if number == PIECE:
                pieces.append(dict(fields(value)))
            elif number == TRAINER:
                trainer = dict(fields(value))
            elif number == NORMALISER:
                normaliser = dict(fields(value))
        if trainer.get(3) != MERGES or normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(3, 1) or not normaliser.get(5, 1):
            raise ValueError("the compiler knows merge models with marked spaces and no other normalisation")
        names = [p.get(TEXT, b"").decode() for p in pieces]
        kinds = [p.get(KIND, NORMAL) for p in pieces]
        if USER in kinds or UNUSED in kinds:
            raise ValueError("the compiler does not know pieces outside the merges")
        scores = np.array([np.frombuffer(p.get(SCORE, bytes(4)), "<f4")[0] for p in pieces])
        self.id_of = {n: k for k, (n, kind) in enumerate(zip(names, kinds)) if kind == NORMAL}
        self.byte_ids = {int(n[3:5], 16): k for k, (n, kind) in enumerate(zip(names, kinds)) if kind == BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("the compiler needs a piece for every byte")
        missing = {c for n in self.id_of for c in n} - self.id_of.keys()
        if missing or any(MARK in n.lstrip(MARK) for n in self.id_of):
            raise ValueError("a character inside a piece has no piece, or a mark is not at its start")
        # Earlier merges have higher scores; pieces of one character come before all merges.
        order = sorted((k for n, k in self.id_of.items() if len(n) > 1), key=lambda k: -scores[k])
        self.rank = {k: r for r, k in enumerate(order, 1)}
        self.rank |= {k: 0 for n, k in self.id_of.items() if len(n) == 1}
        self.names = names
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        for k in order:
            parts = self.merged(names[k], self.rank[k])
            if len(parts) == 2:
                self.halves[k] = parts
        self.trie: dict = {}
        for name, k in self.id_of.items():
            if len(name) == 1 or k in self.halves:
                node = self.trie
                for c in name:
                    node = node.setdefault(c, {})
                node[""] = k
        outputs = [bytes([int(n[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else n.replace(MARK, " ").encode() for n, kind in zip(names, kinds)]
        self.output = np.frombuffer(b"".join(outputs), np.uint8)
        self.output_ends = np.concatenate([[0], np.cumsum([len(o) for o in outputs])])
        self.known: dict[str, list[int]] = {}

    def merged(self, name: str, below: int) -> tuple[int, ...]:
        """The pieces that merges earlier than ``below`` make of a string of known characters."""
        parts = [self.id_of[c] for c in name]
        while len(parts) > 1:
            best = min(((self.rank.get(self.id_of.get(self.names[a] + self.names[b]), below), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] >= below:
                break
            k = best[1]
            parts[k:k + 2] = [self.id_of[self.names[parts[k]] + self.names[parts[k + 1]]]]
        return tuple(parts)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the characters of two pieces together leaves these two."""
        rank, halves, names, id_of = self.rank, self.halves, self.names, self.id_of
        # Merges below the limit have happened while the present two pieces stood at the boundary.
        limit = len(rank) + 1
        while True:
            across = id_of.get(names[left] + names[right])
            if across is not None and rank[across] < limit:
                return False
            a, b = rank[left], rank[right]
            if not a and not b:
                return True
            # Of equal merges the left one comes first: the right piece is undone first, and a merge
            # across the boundary comes before an equal one in it, but after one in the left piece.
            if a > b:
                limit, left = a, halves[left][1]
            else:
                limit, right = b + 1, halves[right][0]

    def encode(self, text: str) -> list[int]:
        """The shortest path of one normalised stretch."""
        found = self.known.get(text)
        if found is not None:
            return found
        n = len(text)
        last = [-2] * (n + 1)          # the piece that ends here on the path of weight zero; -1 is a byte arc
        start = [0] * (n + 1)
        last[0] = -1
        pairs, size = self.pairs, len(self.names)
        for at in range(n):
            before = last[at]
            if before == -2:
                continue
            node, to = self.trie.get(text[at]), at
            if node is None:
                last[at + 1], start[at + 1] = -1, at
                continue
            while node is not None:
                to += 1
                piece = node.get("")
                if piece is not None and last[to] == -2:
                    if before < 0:
                        fits = True
                    else:
                        key = before * size + piece
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = self.stay_apart(before, piece)
                    if fits:
                        last[to], start[to] = piece, at
                if to == n:
                    break
                node = node.get(text[to])
        out: list[int] = []
        at = n
        while at:
            if last[at] >= 0:
                out.append(last[at])
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[start[at]:at].encode()))
            at = start[at]
        out.reverse()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(pairs) >= REMEMBERED_PAIRS:
            pairs.clear()
        self.known[text] = out
        return out

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the bounds of each text."""
        # A mark in the text means a space, too. A space begins a stretch; further spaces before a
        # word, and spaces at the end, belong to one stretch.
        plain = pc.replace_substring(whole(texts), MARK, " ")
        lists = pc.split_pattern(plain, " ")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        names = coded.dictionary.to_pylist()
        sizes = np.diff(bounds)
        void = pc.binary_length(plain).to_numpy(zero_copy_only=False) == 0
        stretch = np.array([MARK + n for n in names], dtype=object)
        empty = names.index("") if "" in names else -1
        keep = np.ones(len(codes), bool)
        keep[bounds[:-1][void & (sizes > 0)]] = False
        blank = np.flatnonzero((codes == empty) & keep)
        if len(blank):
            spaced: dict[str, int] = {}
            ends = np.repeat(bounds[1:], sizes)
            at = 0
            while at < len(blank):
                first = last = int(blank[at])
                while at + 1 < len(blank) and blank[at + 1] == last + 1 and last + 1 < ends[first]:
                    at += 1
                    last += 1
                at += 1
                to = last + 1 if last + 1 < ends[first] else last
                keep[first:to] = False
                name = MARK * (to - first + 1) + names[codes[to]]
                codes[to] = len(names) + spaced.setdefault(name, len(spaced))
            stretch = np.concatenate([stretch, np.array(list(spaced), dtype=object)])
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        codes = codes[keep]
        used, codes = np.unique(codes, return_inverse=True)
        paths = [self.encode(s) for s in stretch[used]]
        lengths = np.fromiter(map(len, paths), np.int64, len(paths))
        flat = np.fromiter((k for p in paths for k in p), np.int32, int(lengths.sum()))
        firsts = np.cumsum(lengths) - lengths
        n = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        return flat[np.repeat(firsts[codes] - ends[:-1], n) + np.arange(ends[-1])], ends[bounds]

    def decode_block(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and their bounds; the mark before the text is taken off again."""
        sizes = np.diff(self.output_ends)[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.output[np.repeat(self.output_ends[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        cut = ends[bounds]
        some = np.flatnonzero(np.diff(cut) > 0)
        first = cut[some]
        keep = np.ones(len(data), bool)
        keep[first[data[first] == 32]] = False
        return data[keep], np.concatenate([[0], np.cumsum(keep)])[cut]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Texts from bytes; runs of bytes that are not UTF-8 become the replacement character."""
    raw = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode(errors="replace") for x in raw.to_pylist()])


def compile_model(path: str) -> Transducer:
    with open(path, "rb") as f:
        return Transducer(f.read())


def encoded(batches, model):
    machine = model.value
    for batch in blocks(batches, size=4 << 20):
        texts = batch.column("text")
        ids, bounds = machine.encode_block(texts)
        data, cut = machine.decode_block(ids, bounds)
        original, at = string_parts(pc.fill_null(texts, ""))
        same = np.diff(cut) == np.diff(at)
        for k in np.flatnonzero(same):
            same[k] = np.array_equal(data[cut[k]:cut[k + 1]], original[at[k]:at[k + 1]])
        kept = [c for c in batch.schema.names if c != "text"]
        pieces = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pieces, pa.array(np.diff(bounds)), pa.array(same)], names=[*kept, "ids", "n_tokens", "round_trip"])


def encode(documents: DataFrame, model_path: str) -> DataFrame:
    """``documents`` without ``text``, with ids, n_tokens and whether decoding gives the text back.

    Null and empty texts have no ids. A text that holds the word mark itself decodes to a space there,
    so it does not round-trip. Columns of these names are replaced; other columns pass as they are.
    The model is read once on the driver and its compiled form is sent to the tasks.
    """
    documents = documents.drop("ids", "n_tokens", "round_trip")
    model = documents.sparkSession.sparkContext.broadcast(compile_model(model_path))
    fields_ = [f for f in documents.schema.fields if f.name != "text"]
    schema = T.StructType([*fields_, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return documents.mapInArrow(partial(encoded, model=model), schema)


def decoded(batches, model):
    machine = model.value
    for batch in batches:
        lists = batch.column("ids")
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        texts = strings(*machine.decode_block(lists.flatten().to_numpy(zero_copy_only=False), bounds))
        kept = [c for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, "text"])


def decode(encoded_rows: DataFrame, model_path: str) -> DataFrame:
    """Rows with ``text`` in place of ``ids``; null ids decode to the empty text."""
    rows = encoded_rows.drop("text")
    model = rows.sparkSession.sparkContext.broadcast(compile_model(model_path))
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "ids"), T.StructField("text", T.StringType())])
    return rows.mapInArrow(partial(decoded, model=model), schema)
