"""Ranked lexical search with buckets of norms.

A document becomes a vector of the impacts of the terms that the items ask for, and an item is the set of its
terms, so a score is an inner product. Vectors are ordered by length into buckets. The longest ones are
searched first and give each item a score to beat. By Cauchy-Schwarz an item passes over every bucket
whose longest vector, times the item's length, stays below that; buckets that no item needs are not even
read. Inside a bucket the coordinates are dealt into groups, and the lengths within the groups bound every
pair of item and document from above. What survives is scored exactly, in integers.

Items are taken in blocks of bounded number; each block meets all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import Words, blocks, mix, stored, string_parts, whole

TOP = 10
ITEMS = 1024                    # expected items of a block
BUCKET = 1024                   # documents of a bucket within a task
GROUPS = 1024                   # groups of coordinates
LONGEST = 0.05                  # share of the vectors that are searched first
PAIR_TERMS = 1 << 21            # term lookups made at once
MARGIN = 1 + 1e-4               # above the rounding of single-precision bounds
# A-Z in lower case, digits and bytes of other characters as they are, anything else a blank.
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms_of(texts: pa.Array) -> Words:
    """Terms of a batch of texts; a null text has none."""
    texts = whole(texts)
    data, bounds = string_parts(texts)
    folded = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes().translate(FOLD))])
    return Words(folded)


def item_terms(batches):
    for batch in blocks(batches):
        words = terms_of(batch.column("text"))
        owner, code = np.divmod(np.unique(words.owners() * max(len(words.vocabulary), 1) + words.codes), max(len(words.vocabulary), 1))
        yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(owner)), words.vocabulary.take(pa.array(code)).cast(pa.string())], names=["item_id", "term"])


def term_counts(batches, vocabulary):
    """Number of terms of each document, and which of the vocabulary it holds how often."""
    wanted = pa.array(vocabulary.value, pa.large_string())
    for batch in blocks(batches):
        words = terms_of(batch.column("text"))
        place = pc.fill_null(pc.index_in(words.vocabulary.cast(pa.large_string()), value_set=wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place = place[words.codes] if len(words.codes) else words.codes
        known = place >= 0
        keys, counts = np.unique(words.owners()[known] * len(wanted) + place[known], return_counts=True)
        owner, term = np.divmod(keys, max(len(wanted), 1))
        bounds = pa.array(np.searchsorted(owner, np.arange(len(words) + 1)), pa.int32())
        lists = lambda x: pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(words.bounds), pa.int64()), lists(term), lists(counts)], names=["doc_id", "n", "terms", "tf"])


def list_parts(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the bounds of each row."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind), bounds - bounds[0]


def impacts(batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, their weighted impacts, and the bounds of each document."""
    terms, bounds = list_parts(batch.column("terms"), np.int64)
    tf, _ = list_parts(batch.column("tf"), np.int64)
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    m = np.repeat(10 + 90 * n * n_docs // n_terms, np.diff(bounds))
    return terms, weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m)), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def norms(batches, collection):
    held = collection.value
    for batch in batches:
        _, x, bounds = impacts(batch, held.weights, held.n_docs, held.n_terms)
        # Sums of squares by row and not as differences of one running sum, whose rounding could hide a short vector.
        squares = np.add.reduceat(np.append(x.astype(np.float64) ** 2, 0.0), bounds[:-1]) * (np.diff(bounds) > 0) if len(bounds) > 1 else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.sqrt(squares))], names=[*batch.schema.names, "norm"])


@dataclass
class Collection:
    """The items of a block, and the weights that the documents give to their terms."""

    item_ids: list
    terms: np.ndarray           # of all items, one after the other
    bounds: np.ndarray
    weights: np.ndarray
    n_docs: int
    n_terms: int

    def lengths(self) -> np.ndarray:
        return np.sqrt(np.diff(self.bounds))


def group_of(terms: np.ndarray) -> np.ndarray:
    return (mix(terms.astype(np.uint64) + np.uint64(1)) % np.uint64(GROUPS)).astype(np.int64)


class Best:
    """The best documents of each item so far; equal scores by ascending id, null ids last."""

    def __init__(self, floors: np.ndarray):
        self.floors = floors.copy()      # a score that TOP documents are known to reach
        self.item = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, item, score, id_, null) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        id_, null = np.concatenate([self.id, id_]), np.concatenate([self.null, null])
        order = np.lexsort((id_, null, -score, item))
        order = order[score[order] > 0]
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < TOP]
        full = order[rank == TOP - 1]
        self.item, self.score, self.id, self.null = item[rank < TOP], score[kept], id_[kept], null[kept]
        self.floors[item[rank == TOP - 1]] = np.maximum(self.floors[item[rank == TOP - 1]], score[full])


def exact_scores(rows, items, collection: Collection, keys, values) -> np.ndarray:
    """Scores of pairs of a bucket's row and an item; ``keys`` are row * terms + term, in order."""
    out = np.zeros(len(rows), np.int64)
    sizes = np.diff(collection.bounds)[items]
    ends = np.cumsum(sizes)
    n_terms, at = len(collection.weights), 0
    while at < len(rows):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_TERMS, "right")), at + 1)
        part = sizes[at:to]
        first = np.repeat(collection.bounds[items[at:to]] - (np.cumsum(part) - part), part)
        wanted = np.repeat(rows[at:to], part) * n_terms + collection.terms[first + np.arange(int(part.sum()))]
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = np.where(keys[place] == wanted, values[place], 0)
        out[at:to] = row_sums(found, np.append(0, np.cumsum(part)))
        at = to
    return out


def searched(batches, collection, floors):
    held: Collection = collection.value
    n_items, n_terms = len(held.item_ids), len(held.weights)
    lengths, best = held.lengths(), Best(floors.value)
    asked = np.zeros((GROUPS, n_items), np.float32)
    np.add.at(asked, (group_of(held.terms), np.repeat(np.arange(n_items), np.diff(held.bounds))), 1)
    asked = np.sqrt(asked)
    for batch in blocks(batches, BUCKET, column=""):
        norm = batch.column("norm").to_numpy()
        active = np.flatnonzero(norm.max(initial=0) * lengths * MARGIN >= best.floors)
        if not len(active) or not norm.max(initial=0):
            continue
        ids = batch.column("doc_id")
        null, ids = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
        terms, x, bounds = impacts(batch, held.weights, held.n_docs, held.n_terms)
        rows = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        inside = np.bincount(rows * GROUPS + group_of(terms), x.astype(np.float64) ** 2, batch.num_rows * GROUPS)
        bound = np.sqrt(inside).astype(np.float32).reshape(-1, GROUPS) @ asked[:, active] * np.float32(MARGIN)
        keys = rows * n_terms + terms
        # The documents with the highest bounds raise the score to beat before the others are looked at.
        k = min(TOP, len(bound))
        likely = np.argpartition(-bound, k - 1, axis=0)[:k]
        row, item = likely.ravel(), np.tile(np.arange(len(active)), k)
        best.add(active[item], exact_scores(row, active[item], held, keys, x), ids[row], null[row])
        bound[row, item] = -1
        row, item = np.nonzero((bound >= best.floors[active].astype(np.float32)) & (bound > 0))
        best.add(active[item], exact_scores(row, active[item], held, keys, x), ids[row], null[row])
    if len(best.item):
        item_ids = pa.array(held.item_ids, pa.int64()).take(pa.array(best.item))
        yield pa.RecordBatch.from_arrays([item_ids, pa.array(best.item.astype(np.int32)), pa.array(best.id, pa.int64(), mask=best.null), pa.array(best.score)],
                                         names=["item_id", "item", "doc_id", "score"])


RESULT = "item_id long, item int, doc_id long, score long"


def ranked(rows: DataFrame) -> DataFrame:
    """The best TOP rows of each item; tasks cut their own lists before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def search_block(documents: DataFrame, item_ids: list, terms: list[list[str]]) -> DataFrame:
    """(item_id, item, doc_id, score, rank) for a block of items."""
    context = documents.sparkSession.sparkContext
    vocabulary = sorted({t for own in terms for t in own})
    place = {t: k for k, t in enumerate(vocabulary)}
    counted = documents.select("doc_id", "text").mapInArrow(
        partial(term_counts, vocabulary=context.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, tf array<int>")
    counted = stored(counted.where("n > 0"), "term-counts")
    sizes = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = {r.term: r["count"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # the block's vocabulary at most
    weights = np.array([math.floor(1000 * math.log((2 * sizes.docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(vocabulary))], np.int64)
    held = Collection(item_ids, np.array([place[t] for own in terms for t in sorted(own)], np.int64),
                      np.append(0, np.cumsum([len(own) for own in terms])).astype(np.int64), weights, sizes.docs, sizes.terms or 1)
    held = context.broadcast(held)
    sized = counted.mapInArrow(partial(norms, collection=held), "doc_id long, n long, terms array<int>, tf array<int>, norm double").where("norm > 0")
    # Vectors of one length, as copies have, are spread by a hash.
    by_norm = sized.repartitionByRange(F.desc("norm"), F.xxhash64("doc_id", "n")).sortWithinPartitions(F.desc("norm"))
    vectors = stored(by_norm, "vectors")
    cut = vectors.agg(F.percentile_approx("norm", 1 - LONGEST, 1000)).first()[0] or 0.0
    search = lambda rows, floors: rows.mapInArrow(partial(searched, collection=held, floors=context.broadcast(floors)), RESULT)
    first = stored(ranked(search(vectors.where(F.col("norm") >= cut), np.zeros(len(item_ids), np.int64))), "longest").drop("rank")
    floors = np.zeros(len(item_ids), np.int64)
    for r in first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).where(F.col("n") == TOP).collect():   # one row an item
        floors[r.item] = r.score
    # No item can use a vector shorter than this.
    least = float((floors / np.maximum(held.value.lengths(), 1e-9)).min() / MARGIN) if len(floors) else 0.0
    rest = search(vectors.where((F.col("norm") < cut) & (F.col("norm") >= least)), floors)
    return ranked(first.unionByName(rest))


def search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the TOP best documents of each item with a score above 0.

    Every row of ``documents`` is one document, repeated ones too; a null text has no terms. Null ids rank
    behind others of the same score. Rows of one item id, null included, are one item with the terms of all of
    them; items without terms, or whose terms no document holds, have no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    every = stored(benchmark.select("item_id", "text").mapInArrow(item_terms, "item_id long, term string").distinct(), "item-terms")
    n_blocks = -(-every.select("item_id").distinct().count() // ITEMS)
    found = []
    for block in range(n_blocks):
        own = every.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block)
        rows = own.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()   # bounded by the block
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0))
        if rows:
            found.append(search_block(documents, [r.item_id for r in rows], [r.terms for r in rows]))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = rf"unnest(regexp_extract_all(translate(text, '{letters}', '{letters.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
WITH words AS (SELECT doc_id, {terms} AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tfs, whole GROUP BY term, docs),
items AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
scores AS (SELECT item_id, t.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
 FROM items JOIN weights USING (term) JOIN tfs t USING (term) JOIN lengths l ON l.doc_id = t.doc_id, whole GROUP BY 1, 2),
placed AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {TOP}"""
