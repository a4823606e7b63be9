"""Which dictionary codes occur anywhere in a text: a substring join of texts and codes.

Codes are cut into pieces of PIECE bytes, the last one flush with the end. How often each piece occurs in the
texts is counted first: a code with a piece that no text holds is out, and every other code looks only for
its rarest piece. Where that occurs, a stretch of text as long as the longest code goes along to the code,
and the two are compared in full. So texts stay in their scan, whatever the size of the dictionary; what
every task knows of it is a bit set of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import cut_lineage

PIECE = 8                       # bytes that fit one number, so equal pieces are equal numbers
FILTER_BITS = 22                # the scan's bit set holds 2^22 bits, whatever the dictionary
BLOCK_BYTES = 2 << 20           # texts that a task looks at at once, or one text
HOT_SHARE, HOT_ROWS = 1000, 10_000   # a piece with more than one in HOT_SHARE meetings, and HOT_ROWS of them, is salted


# -- bytes ----------------------------------------------------------------------------------------

def _blocks(batches, column: str):
    """Pieces of the batches of BLOCK_BYTES of text at most, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the bounds of each; a null text is empty."""
    parts = [t.encode() if t else b"" for t in texts.to_pylist()]
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)


def _values(data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` bytes at each place as one number."""
    out = np.zeros(max(len(data) - n + 1, 0), np.uint64)
    for j in range(n):
        out = (out << np.uint64(8)) | data[j:j + len(out)]
    return out


def _place(values: np.ndarray, n) -> np.ndarray:
    """The bit that stands for pieces of ``n`` bytes."""
    mixed = (values ^ (values >> np.uint64(29)) ^ np.asarray(n).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - FILTER_BITS)


def _found(data: np.ndarray, bounds: np.ndarray, n: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places within a text whose ``n`` bytes pass the bit set, and their values."""
    values = _values(data, n)
    place = _place(values, n)
    passed = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
    at = np.flatnonzero(passed)
    at = at[at + n <= bounds[np.searchsorted(bounds, at, "right")]]
    return at, values[at]


def _cut_codes(batches):
    """(code, code_pos, n, at, piece) of every piece of every code."""
    for batch in batches:
        row, size, at, value = [], [], [], []
        for k, code in enumerate(batch.column("code").to_pylist()):
            raw = code.encode()
            n = min(PIECE, len(raw))
            for a in sorted({*range(0, len(raw) - n + 1, PIECE), len(raw) - n}):
                row.append(k), size.append(n), at.append(a), value.append(int.from_bytes(raw[a:a + n], "big"))
        own = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("code").take(own), batch.column("code_pos").take(own), pa.array(size, pa.int32()), pa.array(at, pa.int32()),
             pa.array(np.array(value, np.uint64).view(np.int64))], names=["code", "code_pos", "n", "at", "piece"])


def _count_pieces(batches, sizes: list[int], bits):
    held = np.frombuffer(bits.value, np.uint8)
    for batch in _blocks(batches, "text"):
        data, bounds = _bytes(batch.column("text"))
        for n in sizes:
            values, counts = np.unique(_found(data, bounds, n, held)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), n, np.int32)), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["n", "piece", "met"])


def _meetings(batches, sizes: list[int], bits, before: int, after: int):
    """The pieces that pass, with ``before`` and ``after`` bytes of text around the place where they begin."""
    held = np.frombuffer(bits.value, np.uint8)
    for batch in _blocks(batches, "text"):
        data, bounds = _bytes(batch.column("text"))
        raw = data.tobytes()
        for n in sizes:
            at, values = _found(data, bounds, n, held)
            own = np.searchsorted(bounds, at, "right") - 1
            low, high = np.maximum(at - before, bounds[own]), np.minimum(at + after, bounds[own + 1])
            rows = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(rows), batch.column("text_key").take(rows), pa.array(np.full(len(at), n, np.int32)), pa.array(values.view(np.int64)),
                 pa.array([raw[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary()), pa.array((at - low).astype(np.int32))],
                names=["key", "text_key", "n", "piece", "stretch", "offset"])


def _bit_set(pieces: DataFrame) -> bytes:
    """The bits of all pieces; its size does not depend on them."""

    def places(batches):
        for batch in batches:
            place = _place(batch.column("piece").to_numpy().view(np.uint64), batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], names=["place"])

    words = pieces.select("piece", "n").mapInArrow(places, "place long").groupBy((F.col("place") / 32).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 32 as int))")).alias("bits")).toArrow()
    held = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    held[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return held.tobytes()


# -- the join -------------------------------------------------------------------------------------

class CodeDetector:
    """Finds the codes of a dictionary in texts; made once, used for any number of frames.

    ``dictionary`` has ``code`` and ``code_pos``; a repeated code counts at its first position, an empty or
    null one not at all.
    """

    def __init__(self, dictionary: DataFrame, key: str = "resource_id", text: str = "pdf_text"):
        self.key, self.text = key, text
        self.context = dictionary.sparkSession.sparkContext
        entries = dictionary.where(F.col("code") != "").groupBy("code").agg(F.min("code_pos").alias("code_pos"))
        kind = entries.schema["code_pos"].dataType.simpleString()
        self.pieces = cut_lineage(entries.mapInArrow(_cut_codes, f"code string, code_pos {kind}, n int, at int, piece long"))
        whole = F.octet_length("code")
        size = self.pieces.agg(F.collect_set("n").alias("n"), F.max("at").alias("before"), F.max(whole - F.col("at")).alias("after")).first()
        self.sizes, self.before, self.after = sorted(size["n"]), size["before"] or 0, size["after"] or 0
        self.bits = self.context.broadcast(_bit_set(self.pieces)) if self.sizes else None

    def seeds(self, texts: DataFrame) -> DataFrame:
        """Each code that may occur with its piece that the texts hold least often: (code, code_pos, n, at, piece, met)."""
        counts = texts.select("text").mapInArrow(partial(_count_pieces, sizes=self.sizes, bits=self.bits), "n int, piece long, met long")
        counts = counts.groupBy("n", "piece").agg(F.sum("met").alias("met"))
        known = self.pieces.join(counts, ["n", "piece"], "left").withColumn("met", F.coalesce("met", F.lit(0).cast("long")))
        rarest = known.groupBy("code", "code_pos").agg(F.min(F.struct("met", "at", "n", "piece")).alias("s"))
        return cut_lineage(rarest.select("code", "code_pos", "s.*").where("met > 0"))

    def hits(self, docs: DataFrame) -> DataFrame:
        """(key, text_key, detected_codes) of the texts that hold any code; ``text_key`` is a hash of the text."""
        texts = docs.select(F.col(self.key).alias("key"), F.xxhash64(self.text).alias("text_key"), F.col(self.text).alias("text"))
        seeds = self.seeds(texts)
        bits = self.context.broadcast(_bit_set(seeds))
        kind = docs.schema[self.key].dataType.simpleString()
        met = texts.mapInArrow(
            partial(_meetings, sizes=self.sizes, bits=bits, before=self.before, after=self.after),
            f"key {kind}, text_key long, n int, piece long, stretch binary, offset int")
        # Fewer than HOT_SHARE pieces can be hot; their meetings are dealt over salts, their codes repeated for each.
        each = seeds.select("n", "piece", "met").distinct()
        limit = F.greatest(F.lit(HOT_ROWS), each.agg(F.coalesce(F.sum("met"), F.lit(0)).alias("all")).scalar() / HOT_SHARE)
        hot = each.withColumn("limit", limit).where("met > limit").select("n", "piece", F.ceil(F.col("met") / F.col("limit")).cast("int").alias("salts"))
        salts = F.coalesce("salts", F.lit(1))
        met = met.join(F.broadcast(hot), ["n", "piece"], "left").withColumn("salt", F.pmod(F.xxhash64("text_key", "key"), salts).cast("int")).drop("salts")
        codes = seeds.join(F.broadcast(hot), ["n", "piece"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        codes = codes.select("n", "piece", "salt", "code", "code_pos", "at", F.encode("code", "UTF-8").alias("raw"))
        same = F.expr("offset >= at AND substring(stretch, offset - at + 1, octet_length(raw)) = raw")
        found = met.join(codes, ["n", "piece", "salt"]).where(same).select("key", "text_key", F.struct("code_pos", "code").alias("c"))
        return found.groupBy("key", "text_key").agg(F.transform(F.array_sort(F.collect_set("c")), lambda c: c["code"]).alias("detected_codes"))

    def __call__(self, docs: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """``docs`` plus ``detected_codes`` (dictionary order, each once) and ``codes_count``.

        ``keep`` makes of the documents what the result needs of them, for instance counts in place of the
        texts; only that takes part in the join.
        """
        kept = docs.withColumn("_text_key", F.xxhash64(self.text))
        kept = keep(kept) if keep else kept
        none = F.array().cast("array<string>")
        if not self.sizes:
            return kept.drop("_text_key").withColumn("detected_codes", none).withColumn("codes_count", F.lit(0))
        hits = self.hits(docs).withColumnsRenamed({"key": "_key", "text_key": "_hit_key"})
        same = F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("_text_key") == F.col("_hit_key"))
        joined = kept.join(hits, same, "left").drop("_key", "_hit_key", "_text_key")
        return joined.withColumn("detected_codes", F.coalesce("detected_codes", none)).withColumn("codes_count", F.size("detected_codes"))


def code_detector(dictionary: DataFrame, key: str = "resource_id", text: str = "pdf_text") -> CodeDetector:
    return CodeDetector(dictionary, key, text)


def detect_codes(docs: DataFrame, dictionary: DataFrame, key: str = "resource_id", text: str = "pdf_text", keep=None) -> DataFrame:
    """``docs`` plus their detected codes."""
    return CodeDetector(dictionary, key, text)(docs, keep)
