"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, drawn from its code point. A run of three letters is bound
into one vector: the product of the first letter's vector permuted twice, the second's permuted once
and the third's. A text is the bundle (sum) of its runs, a language the bundle of its texts, each with
the same weight; a text takes the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import U64, blocks, mix

DIMENSIONS = 512
RUN = 3
DENSE = 1 << 24                 # codes of runs that are looked up in a table
ROWS = 256                      # texts of one matrix product
UNKNOWN = "und"


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """Signs of every code point; each sign is one mixed bit, so all tasks draw the same."""
    words = mix(points.astype(U64)[:, None] * U64(DIMENSIONS) + np.arange(DIMENSIONS // 64, dtype=U64)[None] + U64(1))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return (2 * bits.astype(np.int8) - 1).astype(np.int8)


def letter_numbers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each character's lower-case letter (0: no letter), and the letters' code points."""
    present = np.zeros(0x110000, bool)
    present[codes] = True
    table = np.zeros(0x110000, np.int32)
    known: dict[int, int] = {}
    for point in np.flatnonzero(present).tolist():
        if chr(point).isalpha():
            table[point] = known.setdefault(ord(chr(point).lower()[0]), len(known) + 1)
    return table[codes], np.array([0, *known], np.int64)


def runs(texts: list[str | None]):
    """(text, number of the run) of every run of letters and word ends, the letters of each distinct
    run as code points, and which texts have a letter."""
    padded = [f" {t or ''} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    numbers, points = letter_numbers(codes)
    lettered = np.bincount(owner[numbers > 0], minlength=len(texts)) > 0
    keep = np.ones(len(numbers), bool)
    keep[1:] = (numbers[1:] > 0) | (numbers[:-1] > 0) | (owner[1:] != owner[:-1])
    numbers, owner = numbers[keep].astype(np.int64), owner[keep]
    whole = owner[:-2] == owner[2:]
    size = len(points)
    code = ((numbers[:-2] * size + numbers[1:-1]) * size + numbers[2:])[whole]
    if size ** RUN <= DENSE:
        seen = np.zeros(size ** RUN, bool)
        seen[code] = True
        distinct = np.flatnonzero(seen)
        place = np.zeros(size ** RUN, np.int64)
        place[distinct] = np.arange(len(distinct))
        code = place[code]
    else:
        distinct, code = np.unique(code, return_inverse=True)
    letters = np.stack([points[distinct // size ** 2], points[distinct // size % size], points[distinct % size]], 1)
    return owner[:-2][whole], code, letters, lettered


def run_vectors(letters: np.ndarray) -> np.ndarray:
    points, at = np.unique(letters, return_inverse=True)
    vectors = letter_vectors(points)
    at = at.reshape(letters.shape)
    bound = np.roll(vectors, 2, axis=1)[at[:, 0]] * np.roll(vectors, 1, axis=1)[at[:, 1]] * vectors[at[:, 2]]
    return bound.astype(np.float32)


def text_vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of every text, divided by its number of runs, and which texts have a letter."""
    owner, code, letters, lettered = runs(texts)
    counts = np.bincount(owner * len(letters) + code, minlength=len(texts) * len(letters)).reshape(len(texts), len(letters))
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    return (counts / total).astype(np.float32) @ run_vectors(letters), lettered


def bundled(batches):
    """The sum of the text vectors of each language of a block."""
    for batch in blocks(batches, ROWS):
        vectors, lettered = text_vectors(batch.column("text").to_pylist())
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        known = sorted(set(langs[lettered]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(known, pa.string()), pa.array([vectors[lettered & (langs == k)].sum(0, dtype=np.float64) for k in known], pa.list_(pa.float64()))],
            names=["lang", "bundle"])


def fit(documents: DataFrame) -> dict[str, np.ndarray]:
    """A prototype of unit length for each language of ``documents`` (text, lang).

    Rows with a null language or without a letter teach nothing. The sums are partial aggregates; only
    one vector a language reaches the driver.
    """
    rows = documents.where("lang is not null").select("lang", "text").mapInArrow(bundled, "lang string, bundle array<double>")
    sums = rows.select("lang", F.posexplode("bundle").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for lang, at, value in sums.toPandas().itertuples(index=False):
        out.setdefault(lang, np.zeros(DIMENSIONS))[at] = value
    return {lang: v / max(np.linalg.norm(v), 1e-12) for lang, v in sorted(out.items())}


def identified(batches, prototypes: dict[str, np.ndarray], kept: list[str]):
    langs = [*prototypes, UNKNOWN]
    table = np.stack([*prototypes.values(), np.zeros(DIMENSIONS)]).astype(np.float32)
    for batch in blocks(batches, ROWS):
        vectors, lettered = text_vectors(batch.column("text").to_pylist())
        cosines = (vectors @ table.T) / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        cosines[:, -1] = -2 if prototypes else 0
        best = np.where(lettered, cosines.argmax(1), len(langs) - 1)
        score = np.where(lettered, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array([langs[k] for k in best], pa.string()), pa.array(score, pa.float64())],
            names=[*kept, "lang_pred", "score"])


def identify(documents: DataFrame, prototypes: dict[str, np.ndarray], keep_text: bool = False) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` (the cosine, at least 0) with or without the text.

    Texts that are null or have no letter are ``und`` with score 0, as are all texts without a
    prototype. Equal cosines take the first language by name. Columns of these names are replaced.
    """
    documents = documents.drop("lang_pred", "score")
    fields = [f for f in documents.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(partial(identified, prototypes=prototypes, kept=[f.name for f in fields]), schema)
