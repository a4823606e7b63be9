"""Helpers that several operators share: folds, scratch tables, word hashes, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import shared_folder

U64 = np.uint64
# Odd multipliers and shifts of the 64-bit finaliser, and the multipliers of the two word hashes.
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
WORD_1, WORD_2 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
PAIR = U64(0xC2B2AE3D27D4EB4F)
BLOCK_ROWS, BLOCK_BYTES = 2000, 3 << 20
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_fold(key: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the key as text leaves ``part``; a null key is in no fold."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors.

    The shuffles of the write go with it; else they would stay on disk until the driver collects its garbage.
    """
    path, conf = scratch(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mounted(path: str) -> str:
    """The path of a shared folder as tasks open it; other stores have to be mounted."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: tasks map these files into memory, so name a mounted folder")
    return path


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def string_parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an array of strings, and where each begins and ends."""
    strings = strings.cast(pa.large_string())
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]] if len(strings) else data[:0], bounds - bounds[0]


def powers(base: U64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def hash_strings(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string, made of two polynomials over its bytes and its length."""
    if not len(strings):
        return np.zeros(0, U64)
    data, bounds = string_parts(strings)
    lengths = np.diff(bounds)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], lengths)
    most = int(lengths.max(initial=0))
    out = lengths.astype(U64)
    for base in (WORD_1, WORD_2):
        total = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * powers(base, most)[place], out=total[1:], dtype=U64)
        out = mix(out ^ (total[bounds[1:]] - total[bounds[:-1]]))
    return out


def whole(texts: pa.Array) -> pa.Array:
    """A copy of a slice of texts with offsets from zero, nulls as empty texts.

    Arrow's case functions misread a slice whose offsets were widened.
    """
    return pc.fill_null(texts.take(pa.array(np.arange(len(texts)))), "").cast(pa.large_string())


class Words:
    """Words of a batch of texts: ``codes`` into ``vocabulary``, and ``bounds`` of each text.

    A-Z are lower-cased; words are runs of characters other than space and \\x09-\\x0D. A null text
    has no words.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(whole(texts)))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = coded.dictionary
        full = pc.binary_length(self.vocabulary).to_numpy(zero_copy_only=False) > 0
        bounds = bounds - bounds[0]
        if not full.all():
            kept = full[codes] if len(codes) else np.zeros(0, bool)
            bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
            codes = (np.cumsum(full) - 1)[codes[kept]]
            self.vocabulary = self.vocabulary.filter(pa.array(full))
        self.codes, self.bounds = codes, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """Per text, the sorted set of hashes of its runs of ``size`` words.

    A text with fewer words has the run of all its words; a text without words has none.
    """
    hashes = hash_strings(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, U64)
    runs = hashes.copy()
    for k in range(1, size):
        n = max(len(hashes) - k, 0)
        runs[:n] = mix(runs[:n] * PAIR + hashes[k:k + n])
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        elif b > a:
            whole = hashes[a:a + 1].copy()
            for k in range(a + 1, b):
                whole = mix(whole * PAIR + hashes[k:k + 1])
            out.append(whole + U64(1))
        else:
            out.append(hashes[:0])
    return out


def hand_back() -> None:
    """Give memory that is no longer used back to the machine.

    A worker waits for its next task, and for all stages without Python in between, with whatever its allocators have kept.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``rows`` rows and ``size`` bytes of ``column`` at most, or of one row.

    A task's memory then depends on its longest text and not on how the rows are packed. Behind the last
    piece the task hands its unused memory back.
    """
    for batch in batches:
        ends = None
        if column in batch.schema.names:
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = min(at + rows, batch.num_rows)
            if ends is not None:
                before = ends[at - 1] if at else 0
                to = min(to, max(int(np.searchsorted(ends, before + size, "right")), at + 1))
            yield batch.slice(at, to - at)
            at = to
    hand_back()


def on_tables(function, **fixed):
    """``function`` over whole groups with some arguments fixed, typed as Spark wants it."""

    def call(group: pa.Table) -> pa.Table:
        return function(group, **fixed)

    return call


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def connected(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Rounds of large and small stars: every node hangs its larger, then its smaller neighbours on
    the smallest one. Minima are partial aggregates, and a hub's edges meet its minimum in a join
    that adaptive execution can split, so no task holds a whole component. Each round is written to
    the shared folder; they end when the edges no longer change, and their number grows with the
    logarithm of the longest path.
    """

    def keep(df: DataFrame) -> tuple[DataFrame, tuple]:
        # Not by an observation: a session with one can no longer ship models that remember their session.
        kept = stored(df, name)
        return kept, tuple(kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first())

    now, before = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = now.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Every node keeps its own smallest neighbour too, which holds the stars together.
        large = large.union(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now, after = keep(small.union(lower.select("a", F.col("m").alias("b"))).distinct())
        if after == before:
            break
        before = after
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.union(out.select("component", "component")).distinct()
