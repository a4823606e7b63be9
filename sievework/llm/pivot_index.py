"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points in order, the head of its permutation. An
inverted list holds the vectors that have a pivot among theirs. Vectors that share SHARED pivots or
more are candidates, and the exact cosine of candidates is checked in double precision.

Equal vectors are one entry with a weight, so copies never meet each other. A list is cut into blocks,
and every pair of blocks is one group of a shuffle: a long list becomes many tasks, none of them
large. A pair that meets in several lists is counted in that of its smallest shared pivot. A group
gives what its members have found, not their pairs: the weight linked to each vector, and one edge a
vector to a spanning forest.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import connected, on_tables, stored

COSINE = 0.95
NEAREST, SHARED = 8, 2          # pivots of a vector; pivots that candidates share
PIVOTS_PER_ROOT = 4             # reference points for each root of the number of vectors
LEAST_PIVOTS = 32
APART = 0.7                     # largest cosine of two reference points
BLOCK = 512                     # vectors of a block of a list


def unit(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision of lists of one length, and which of them are usable."""
    flat = np.asarray(rows.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False), np.float64)
    x = flat.reshape(len(rows), -1)
    with np.errstate(all="ignore"):
        big = np.abs(x).max(axis=1, keepdims=True, initial=0)
        x = x / big
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, np.isfinite(x).all(axis=1)


def described(batches, pivots):
    """Unit vector and nearest pivots, in order, of each usable entry."""
    points = pivots.value
    for batch in batches:
        lists = batch.column("embedding")
        for size, at in by_length(lists):
            x, good = unit(lists.take(pa.array(at)))
            x, at = x[good], at[good]
            if not len(at) or size != points.shape[1]:
                near = np.zeros((len(at), 1), np.int64)     # vectors of another length are compared in a list of their own
                near[:] = -size
            else:
                closeness = x @ points.T
                m = min(NEAREST, len(points))
                near = np.argpartition(-closeness, m - 1, axis=1)[:, :m]
                near = np.take_along_axis(near, np.argsort(-np.take_along_axis(closeness, near, 1), axis=1, kind="stable"), 1)
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [rows.column("entry"), rows.column("weight"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                names=["entry", "weight", "unit", "pivots"])


def by_length(lists: pa.Array):
    """Places of the lists of each length; null and empty lists are left out."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]):
        yield int(size), np.flatnonzero(lengths == size)


def forest(linked: np.ndarray) -> np.ndarray:
    """The smallest member that each member of a symmetric boolean matrix reaches."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None], len(linked)).min(axis=1, initial=len(linked))
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def compared(group: pa.Table, cosine: float, shared: int) -> pa.Table:
    """Compare two blocks of a list, or one with itself."""
    pivot = group.column("pivot")[0].as_py()
    one, other = group.column("block_a")[0].as_py(), group.column("block_b")[0].as_py()
    block = group.column("block").to_numpy()
    entries, weights = group.column("entry").to_numpy(), group.column("weight").to_numpy()
    x = np.stack([np.frombuffer(v, np.float64) for v in group.column("unit").to_pylist()])
    pivots = np.stack([np.asarray(v) for v in group.column("pivots").to_pylist()])
    a, b = np.flatnonzero(block == one), np.flatnonzero(block == other)
    codes, at = np.unique(pivots, return_inverse=True)
    holds = np.zeros((len(x), len(codes)), np.float32)
    np.put_along_axis(holds, at.reshape(pivots.shape), 1, axis=1)
    i, j = np.nonzero((holds[a] @ holds[b].T >= min(shared, pivots.shape[1])) & (x[a] @ x[b].T >= cosine - 1e-9))
    i, j = a[i], b[j]
    if one == other:
        i, j = i[i < j], j[i < j]
    # The product above may round differently from the sum below, which decides.
    link = np.einsum("kd,kd->k", x[i], x[j]) >= cosine
    i, j = i[link], j[link]
    first = codes[np.argmax(holds[i] * holds[j] > 0, axis=1)] == pivot if len(i) else np.zeros(0, bool)
    own_i, own_j = i[first], j[first]
    found = np.bincount(own_i, weights[own_j], len(x)) + np.bincount(own_j, weights[own_i], len(x))
    order = np.argsort(entries, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    linked = np.zeros((len(x), len(x)), bool)
    linked[place[i], place[j]] = linked[place[j], place[i]] = True
    low = entries[order[forest(linked)[place]]]
    some = np.flatnonzero((found > 0) | (low != entries))
    return pa.table({"entry": entries[some], "found": found[some].astype(np.int64), "low": low[some]})


def pick_pivots(entries: DataFrame, total: int) -> np.ndarray:
    """Reference points: distinct usable vectors of the most frequent length, the first by a hash of
    their values, and none near to another, so that a dense group does not hold most of them. The
    sample grows with the root of the number of vectors."""
    wanted = max(LEAST_PIVOTS, int(np.ceil(PIVOTS_PER_ROOT * np.sqrt(total))))
    lengths = entries.groupBy(F.size("embedding").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return np.zeros((0, 0))
    rows = entries.where(F.size("embedding") == lengths["n"]).orderBy(F.xxhash64("embedding", F.lit(5)), "entry").limit(wanted).select("embedding").toArrow()
    x, good = unit(rows.column("embedding").combine_chunks())
    kept: list[int] = []
    for k in np.flatnonzero(good):
        if not kept or (x[kept] @ x[k]).max() < APART:
            kept.append(k)
    return x[kept]


def linked_vectors(embeddings: DataFrame, cosine: float = COSINE, shared: int = SHARED) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding).

    Null, empty and zero vectors, and those with a null or non-finite component, link with nothing and
    are their own component. Rows that repeat are vectors of their own, and link with each other. A
    null id never names a component that has other ids. Vectors of other lengths than the most
    frequent one are compared with all of their length. The pivots are a sample, every vector is
    indexed, and no list is cut.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", "embedding")
    usable = F.coalesce(F.exists("embedding", lambda v: v != 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    keyed = rows.select("vec_id", F.when(usable, F.xxhash64(F.transform("embedding", lambda v: v + F.lit(0.0)))).alias("entry"), "embedding")
    groups = keyed.where("entry is not null").groupBy("entry").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    entries = stored(groups, "vectors")
    points = pick_pivots(entries, entries.count())
    if not len(points):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = spark.sparkContext.broadcast(points)
    index = stored(entries.mapInArrow(partial(described, pivots=pivots), "entry long, weight long, unit binary, pivots array<int>"), "pivot-lists")
    posted = index.select("*", F.explode("pivots").alias("pivot"))
    # Blocks of about BLOCK vectors by hash, as many as the list's length asks for.
    lengths = index.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = posted.join(F.broadcast(lengths), "pivot").withColumn("block", F.pmod(F.xxhash64("entry", F.lit(3)), "blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("block_a"), F.greatest("block", k).alias("block_b")))
    dealt = placed.select("entry", "weight", "unit", "pivots", "pivot", "block", F.explode(pairs).alias("p")).select("*", "p.block_a", "p.block_b").drop("p")
    found = stored(dealt.groupBy("pivot", "block_a", "block_b").applyInArrow(
        on_tables(compared, cosine=cosine, shared=shared), "entry long, found long, low long"), "found")
    links = found.groupBy("entry").agg(F.sum("found").alias("found"))
    labels = connected(found.where("low <> entry").select(F.col("entry").alias("a"), F.col("low").alias("b")), "vector-links")
    named = entries.select("entry", "rep", "weight").join(labels.withColumnRenamed("node", "entry"), "entry", "left").withColumn("component", F.coalesce("component", "entry"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "component").join(links, "entry", "left").select("entry", "component_id", (F.coalesce("found", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = keyed.select("vec_id", "entry").join(named, "entry", "left")
    component = F.when(F.col("entry").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.expr("vec_id <=> component_id"))
