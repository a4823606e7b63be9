"""Near duplicates by a multi-index Hamming join over b-bit minimum signatures.

A document's set of word shingles gives ``VALUES`` minima of ``BITS`` bits each. Two documents may
differ in ``DISTANCE`` of the values; the signature is split into chunks so that in one chunk at
least they differ in one value or none (pigeonhole), and every chunk is looked up with each of its
values left out in turn. So every pair within the distance meets under some key. Pairs at the
similarity threshold differ in a fifth of the values on average and stay within the distance in all
but one of some ten thousand cases. Classes that meet, directly or by others, form a family, and all
of a family are compared on their full sets.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import U64, Words, blocks, connected, mix, on_tables, shingles, signed, stored

VALUES, BITS, DISTANCE = 64, 16, 25
CHUNKS = (DISTANCE + 2) // 2        # one chunk has at most one wrong value
FIRST_CHUNKS = 3                    # chunks whose keys the first stars use
BLOCK = 1024                        # classes of a family that are compared as a matrix
BLOCK_SETS, BLOCK_MEMBERS = 1 << 16, 1 << 20    # classes, and members of their sets, of a family that one task compares with as many others
PAIRS, LOOKUPS = 1 << 20, 1 << 21   # candidates, and members of their smaller sets, that are looked at together
COLUMNS = 4096                      # shingles of one matrix product
FILTER_BITS = 24                    # the scan filter holds 2^24 bits, whatever the data
SEEDS = mix(np.arange(1, 2 * VALUES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
EDGES = np.linspace(0, VALUES, CHUNKS + 1).round().astype(int)


def signature(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Low bits of the minima of each run of ``hashes`` that begins at ``starts``, one row a run."""
    out = np.empty((len(starts), VALUES), np.uint16)
    for k in range(VALUES):
        mixed = hashes * (SEEDS[k] | U64(1)) + SEEDS[VALUES + k]
        mixed ^= mixed >> U64(32)
        out[:, k] = (mix(np.minimum.reduceat(mixed, starts)) & U64((1 << BITS) - 1)).astype(np.uint16)
    return out


def set_hash(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set that does not depend on order."""
    return np.array([mix(np.array([np.add.reduce(mix(s)) + U64(len(s))], U64))[0] if len(s) else 0 for s in sets], U64)


def sketch(batches, size: int):
    for batch in blocks(batches):
        sets = shingles(Words(batch.column("text")), size)
        full = [s for s in sets if len(s)]
        signs: list = [None] * len(sets)
        if full:
            lengths = np.array([len(s) for s in full])
            rows = signature(np.concatenate(full), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            for at, row in zip([k for k, s in enumerate(sets) if len(s)], rows):
                signs[at] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), signed(set_hash(sets)), pa.array(signs, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "cls", "sig"])


def chunk_keys(batches, chunks: int):
    """For each class, a key for every chunk and value left out of it."""
    for batch in blocks(batches, 500):
        n = batch.num_rows
        signs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(n, VALUES).astype(U64)
        keys = []
        for c, (a, b) in enumerate(zip(EDGES[:chunks], EDGES[1:])):
            for left_out in range(a, b):
                key = np.full(n, mix(np.array([c * VALUES + left_out + 1], U64))[0], U64)
                for k in range(a, b):
                    if k != left_out:
                        key = mix(key ^ (signs[:, k] + U64(k << BITS)))
                keys.append(key)
        keys = np.concatenate(keys)
        yield pa.RecordBatch.from_arrays([signed(keys), *(pa.array(np.tile(batch.column(c).to_numpy(), len(keys) // n)) for c in ("cls", "comp"))], names=["key", "cls", "comp"])


def scan_place(cls: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    return mix(cls.view(U64) ^ mix(doc_id.view(U64))) >> U64(64 - FILTER_BITS)


def wanted_sets(batches, size: int, bits):
    """The sets of the representatives that the bit filter lets through (and a few others)."""
    held = np.frombuffer(bits.value, np.uint8)
    for batch in blocks(batches):
        sets = shingles(Words(batch.column("text")), size)
        classes = set_hash(sets)
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        place = scan_place(classes, ids)
        take = np.flatnonzero((held[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1)
        yield pa.RecordBatch.from_arrays(
            [signed(classes[take]), pa.array([sets[k].tobytes() for k in take], pa.binary())], names=["cls", "members"])


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of incidence matrices over shingles that recur."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    recurs = counts > 1
    place = np.cumsum(recurs) - 1
    kept = recurs[column]
    owner, column = owner[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(recurs.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        out += held @ held.T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """The first member that each member of a symmetric boolean matrix reaches."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(np.where(linked, label[None], len(linked)).min(axis=1, initial=len(linked)), label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put both ends of each link under the smaller of their labels; a label is a member that has it itself."""
    while True:
        one, other = label[a], label[b]
        apart = one != other
        if not apart.any():
            return
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while (label[label] != label).any():
            label[:] = label[label]


def rare_first_forest(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """What :func:`forest` makes of all links among the sets, without a matrix of all pairs.

    Members are ordered from rare to frequent. Linked sets share a member among the first of each, which are
    as many as a set can miss of its own, and one more; only sets that meet in one of these are candidates.
    Links to the first set of each meeting join copies; then what is left apart is compared, pair by pair.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    width = len(counts)
    held = np.sort(owner * width + rank[column])        # by set, then from rare to frequent
    member = held - owner * width
    at = np.arange(len(held)) - starts[owner]
    early = np.flatnonzero(at < (sizes + (-percent * sizes // 100) + 1)[owner])
    early = early[np.argsort(member[early], kind="stable")]
    label = np.arange(len(sets))

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pairs are linked, by members of the smaller set that the other one has."""
        small, large = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
        out, ends = np.zeros(len(a), bool), np.cumsum(sizes[small])
        first = 0
        while first < len(a):
            to = max(int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LOOKUPS, "right")), first + 1)
            s, l = small[first:to], large[first:to]
            pair = np.repeat(np.arange(len(s)), sizes[s])
            inside = np.arange(len(pair)) - (np.cumsum(sizes[s]) - sizes[s])[pair]
            wanted = l[pair] * width + member[starts[s][pair] + inside]
            place = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
            both = np.bincount(pair[held[place] == wanted], minlength=len(s))
            out[first:to] = 100 * both >= percent * (sizes[s] + sizes[l] - both)
            first = to
        return out

    def look(i: np.ndarray, j: np.ndarray) -> None:
        """Join what is linked among the sets that meet in these places, unless it is known to belong together."""
        a, b = owner[i], owner[j]
        # At the first member that two sets share, what is left of both must do for a link.
        left = np.minimum(sizes[a] - at[i], sizes[b] - at[j])
        some = (label[a] != label[b]) & ((100 + percent) * left >= percent * (sizes[a] + sizes[b]))
        pairs = np.unique(np.minimum(a, b)[some] * len(sets) + np.maximum(a, b)[some])
        a, b = pairs // len(sets), pairs % len(sets)
        some = linked(a, b)
        merge(label, a[some], b[some])

    def meetings() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places that meet, by meeting and label, small meetings first; the end of each one's label there and of its meeting."""
        key = member[early]
        new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        low, high = np.minimum.reduceat(label[owner[early]], np.flatnonzero(new)), np.maximum.reduceat(label[owner[early]], np.flatnonzero(new))
        kept = (low != high)[group]
        places, group = early[kept], group[kept]
        group = np.bincount(group, minlength=len(low))[group] * len(low) + group
        order = np.lexsort((label[owner[places]], group))
        places, group = places[order], group[order]
        ends = lambda change: np.repeat(*(lambda e: (e, np.diff(e, prepend=0)))(np.append(np.flatnonzero(change) + 1, len(places))))
        other = group[1:] != group[:-1]
        own = label[owner[places]]
        return places, ends(other | (own[1:] != own[:-1])), ends(other)

    def among(places: np.ndarray, own: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Look at each of the ``own`` with those from ``begin`` to ``end``; all of them are positions in ``places``."""
        counts = end - begin
        total, first = np.append(0, np.cumsum(counts)), 0
        while first < len(own):
            to = max(int(np.searchsorted(total, total[first] + PAIRS, "right")) - 1, first + 1)
            k = np.repeat(np.arange(first, to), counts[first:to])
            i, j = places[own[k]], places[begin[k] + np.arange(total[first], total[to]) - total[k]]
            apart = label[owner[i]] != label[owner[j]]
            look(i[apart], j[apart])
            first = to

    places, _, end = meetings()
    firsts = np.flatnonzero(np.append(True, end[1:] != end[:-1]))[:len(places)]
    among(places, firsts, firsts + 1, end[firsts])
    places, own_end, end = meetings()
    among(places, np.arange(len(places)), own_end, end)
    return label


def compared(group: pa.Table, percent: int) -> pa.Table:
    """Edges of a spanning forest of the links in the families of a group, or in two blocks of one."""
    group = group.sort_by([("family", "ascending"), ("cls", "ascending")])
    families, classes = group.column("family").to_numpy(), group.column("cls").to_numpy()
    sets = [np.frombuffer(x, U64) for x in group.column("members").to_pylist()]
    bounds = np.append(np.flatnonzero(np.append(True, families[1:] != families[:-1])), len(families))
    nodes, lows = [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            if b - a > BLOCK:
                label = rare_first_forest(sets[a:b], percent)
            else:
                sizes = np.array([len(s) for s in sets[a:b]], np.float64)
                both = common_counts(sets[a:b])
                label = forest(100 * both >= percent * (sizes[:, None] + sizes[None] - both))
            some = np.flatnonzero(label != np.arange(b - a))
            nodes.append(classes[a:b][some])
            lows.append(classes[a:b][label[some]])
    none = [np.zeros(0, np.int64)]
    return pa.table({"a": np.concatenate(nodes or none), "b": np.concatenate(lows or none)})


def filter_bits(reps: DataFrame) -> bytes:
    """A bit set of fixed size of the (class, document) pairs whose sets are needed."""

    def places(batches):
        for batch in batches:
            place = scan_place(batch.column("cls").to_numpy(), batch.column("rep").fill_null(0).to_numpy())
            yield pa.RecordBatch.from_arrays([signed(place)], names=["place"])

    words = reps.select("cls", "rep").mapInArrow(places, "place long").groupBy((F.col("place") / 32).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 32 as int))")).alias("bits")).toPandas()
    held = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return held.tobytes()


def known_groups(links: DataFrame) -> DataFrame:
    """(cls, comp): a smaller class that each class with edges belongs with, by two steps of pointers.

    Equal labels mean one component; the reverse need not hold.
    """
    up = links.select(F.greatest("a", "b").alias("cls"), F.least("a", "b").alias("comp")).groupBy("cls").agg(F.min("comp").alias("comp"))
    for _ in range(2):
        higher = up.select(F.col("cls").alias("comp"), F.col("comp").alias("above"))
        up = up.join(higher, "comp", "left").select("cls", F.coalesce("above", "comp").alias("comp"))
    return up


class NearDuplicates:
    """Classes of documents with equal shingle sets, and the links between classes.

    ``documents`` needs ``doc_id`` and ``text``; other columns are ignored. Empty and null texts have
    an empty set and no links. Rows that repeat a document or a text fall into one class. A null
    ``doc_id`` is a document like any other, but never names a component that has other ids.
    """

    def __init__(self, documents: DataFrame, size: int = 5, percent: int = 80):
        self.documents = documents.select("doc_id", "text")
        self.size, self.percent = size, percent
        self.spark = documents.sparkSession
        keyed = self.documents.withColumn("text_key", F.xxhash64("text"))
        self.rows = stored(keyed.mapInArrow(partial(sketch, size=size), "doc_id long, text_key long, n_shingles long, cls long, sig binary"), "sketches")
        self.classes = stored(
            self.rows.where("n_shingles > 0").groupBy("cls").agg(
                F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")

    def keys(self, labels: DataFrame | None = None, chunks: int = CHUNKS) -> DataFrame:
        """(key, cls, comp) of all classes; without labels every class is a component of its own."""
        rows = self.classes.select("cls", "sig")
        rows = rows.withColumn("comp", F.col("cls")) if labels is None else rows.join(labels, "cls", "left").select("cls", "sig", F.coalesce("comp", "cls").alias("comp"))
        return rows.mapInArrow(partial(chunk_keys, chunks=chunks), "key long, cls long, comp long")

    def families(self) -> DataFrame:
        """(cls, family) of the classes that share a bucket with another one, directly or by others.

        The keys of a few chunks put most classes that belong together under one label. The keys of
        all chunks then need to be looked at only where a bucket holds several labels, so a group of
        copies never shows all its members under all its keys.
        """
        keys = self.keys(chunks=FIRST_CHUNKS)
        stars = keys.groupBy("key").agg(F.min("cls").alias("centre"), F.max("cls").alias("last")).where("centre <> last").select("key", "centre")
        edges = keys.join(stars, "key").where("cls <> centre").select(F.col("cls").alias("a"), F.col("centre").alias("b")).distinct()
        labels = stored(known_groups(edges), "labels")
        keys = self.keys(labels)
        split = keys.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key", "low")
        joined = keys.join(split, "key").where("comp <> low").select(F.col("comp").alias("a"), F.col("low").alias("b")).distinct()
        every = stored(labels.select(F.col("cls").alias("a"), F.col("comp").alias("b")).union(joined), "family-edges")
        return connected(every, "families").select(F.col("node").alias("cls"), F.col("component").alias("family"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` with the shingle sets of its classes; only they, and few others, leave the scan."""
        reps = wanted.join(self.classes, "cls").select("cls", "rep")
        bits = self.spark.sparkContext.broadcast(filter_bits(reps))
        found = self.documents.mapInArrow(partial(wanted_sets, size=self.size, bits=bits), "cls long, members binary")
        return found.join(wanted, "cls").groupBy("cls", *(c for c in wanted.columns if c != "cls")).agg(F.first("members").alias("members"))

    def components(self) -> DataFrame:
        """(cls, comp) of the classes that have links, named by the smallest class.

        Within each family all classes are compared on their full sets, the larger families by their rare
        members first. Blocks hold as many sets as a task can, since each set is sent to a task for every
        block of its family; a task gives a forest of what it has linked, not its pairs. Small families
        share tasks.
        """
        families = stored(self.families().join(self.classes.select("cls", "n"), "cls"), "families")
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_MEMBERS))
        alone = (F.count("*") > BLOCK) | (F.sum("n") > BLOCK_MEMBERS / 4)
        sizes = families.groupBy("family").agg(blocks.alias("blocks"), alone.alias("alone"))
        placed = families.drop("n").join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("cls", F.lit(3)), "blocks"))
        n, members = families.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        shared = max(n // BLOCK, members // BLOCK_MEMBERS) + 1
        packed = F.when(F.col("alone"), F.col("family")).otherwise(F.pmod(F.xxhash64("family", F.lit(5)), F.lit(shared)))
        full = stored(self.sets(placed.withColumn("pack", packed)), "sets")
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("x"), F.greatest("block", k).alias("y")))
        dealt = full.select("cls", "family", "members", "pack", "alone", F.explode(pairs).alias("p")).select("*", "p.x", "p.y").drop("p")
        edges = dealt.groupBy("alone", "pack", "x", "y").applyInArrow(on_tables(compared, percent=self.percent), "a long, b long")
        return connected(edges, "links").select(F.col("node").alias("cls"), F.col("component").alias("comp"))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id (smallest doc_id), kept, one row for each row of documents."""
        groups = self.classes.join(self.components(), "cls", "left").select("cls", "rep", F.coalesce("comp", "cls").alias("comp"))
        named = groups.join(groups.groupBy("comp").agg(F.min("rep").alias("component_id")), "comp").select("cls", "component_id")
        out = self.rows.withColumn("cls", F.when(F.col("n_shingles") > 0, F.col("cls"))).join(named, "cls", "left")
        component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        out = out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
        return out.withColumn("kept", F.expr("doc_id <=> component_id"))


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: its set size, the component of near duplicates, and whether it names it."""
    return NearDuplicates(documents, size, percent).result().drop("text_key")


def without_near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each component; documents without words all stay.

    Rows that repeat both id and text are one document and stay once. Removed rows are matched by id
    and by a hash of the text, so two texts under one id do not go together.
    """
    marked = stored(NearDuplicates(documents, size, percent).result(), "marked")
    gone = marked.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_key"))
    out = documents.join(gone, same, "left_anti")
    if marked.where("kept and n_shingles > 0").groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        return out
    whole = F.coalesce("text", F.lit("")).rlike("[^ \\x09-\\x0D]")
    return out.where(whole).dropDuplicates(["doc_id", "text"]).unionByName(out.where(~whole))
