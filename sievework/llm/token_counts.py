"""Token counts with a digest cache.

A text is known by the digest of its normalised content (runs of blanks count as one, as they do for the
tokenizer) and the digest of the tokenizer's file. Counts that the cache holds are joined; of the rest
every distinct content is encoded once and appended. A second run over the same texts encodes nothing.

Texts are encoded by the tokenizer's own library, word by word: blanks always end a token, so the count
of a text is the sum over its stretches between blanks, and a task encodes a stretch once.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm.common import blocks, scratch, whole

BLANKS = r"[\x20\x09-\x0D]+"
LIMIT = 2048
REMEMBERED = 300_000            # stretches whose counts a task keeps
CACHE = "content string, tokenizer string, n_tokens long"


def content_digest(text):
    """Digest of the text with runs of blanks as one space and none at the ends; null is empty."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "))
    return F.sha2(plain.cast("binary"), 256)


class Counter:
    """A tokenizer and the counts of stretches it has seen; one lives in a worker for all its tasks."""

    def __init__(self, definition: str):
        self.definition = definition
        self.known: dict[str, int] = {}
        self.tokenizer: Tokenizer | None = None

    def __reduce__(self):
        return Counter, (self.definition,)

    def counts(self, stretches: list[str]) -> np.ndarray:
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_str(self.definition)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        new = [s for s in stretches if s not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = stretches
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            self.known.update(zip(part, map(len, self.tokenizer.encode_batch_fast(part, add_special_tokens=False))))
        return np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))


def counted(batches, counter):
    for batch in blocks(batches):
        lists = pc.ascii_split_whitespace(whole(batch.column("text")))
        coded = lists.flatten().dictionary_encode()
        per_stretch = counter.value.counts(coded.dictionary.to_pylist())
        totals = np.concatenate([[0], np.cumsum(per_stretch[coded.indices.to_numpy(zero_copy_only=False)])]) if len(coded) else np.zeros(1, np.int64)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(totals[bounds[1:]] - totals[bounds[:-1]])], names=["content", "n_tokens"])


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; a folder that holds none yet is an empty cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(folder)


def fill_cache(documents: DataFrame, tokenizer_path: str, cache: str) -> str:
    """Append the counts of all distinct texts that the cache lacks; gives the tokenizer's digest.

    Only digests are grouped, so a text with many copies is one row per task before the shuffle. One
    row for each missing digest is looked up again by key and digest and carries its text to the
    encoder; rows that repeat it exactly give the same count and are stored once.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    version = hashlib.sha256(definition.encode()).hexdigest()
    rows = documents.select(F.xxhash64("doc_id").alias("row"), content_digest(F.col("text")).alias("content"), "text")
    held = read_cache(spark, cache).where(F.col("tokenizer") == version).select("content")
    missing = rows.groupBy("content").agg(F.min("row").alias("row")).join(held, "content", "left_anti")
    texts = rows.join(missing, ["row", "content"], "left_semi").select("content", "text")
    counter = spark.sparkContext.broadcast(Counter(definition))
    counts = texts.mapInArrow(partial(counted, counter=counter), "content string, n_tokens long").groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    counts.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return version


def count_tokens(documents: DataFrame, tokenizer_path: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``documents`` (doc_id, text).

    Null and empty texts have 0 bytes and 0 tokens. Special strings in a text are encoded as the
    tokenizer does by default; none are added. Rows that repeat are counted each. ``cache`` is a folder
    that later runs may share; without one the run has its own.
    """
    spark = documents.sparkSession
    cache = cache or scratch(spark, "token-counts")
    version = fill_cache(documents, tokenizer_path, cache)
    held = read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    rows = documents.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), content_digest(F.col("text")).alias("content"))
    return rows.join(held, "content", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
