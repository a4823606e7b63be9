"""Document fingerprints by winnowing, in DataFrame expressions alone.

Every run of ``K`` characters of a text is hashed; of each ``WINDOW`` neighbouring hashes the smallest is
selected, the rightmost of equal ones, and kept with its position. Two texts that share a passage of
``K + WINDOW - 1`` characters or more share a selected hash, and the positions tell where. A text is
walked in pieces of ``PIECE`` windows that overlap, so that a very long one needs no more memory than a
piece; the selection is the same as in one walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, WINDOW, PIECE, BLOCK = 16, 32, 1 << 14, 4
CUTS, PER_TASK = 256, 16        # quantiles of the document order, and buckets for each task
LOW_31, LOW_32 = (1 << 31) - 1, (1 << 32) - 1


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def minima(values: Column, window: int) -> Column:
    """At each place the minimum of the ``window`` values from there on, or of those that are left."""

    def widened(values: Column, size: int) -> Column:
        if size == window:
            return values
        step = min(size, window - size)
        # By place, without a shifted copy; behind the end there is null, which least() skips.
        return let(values, lambda v: widened(F.transform(v, lambda x, i: F.least(x, F.get(v, i + step))), size + step))

    return widened(values, 1)


def lowest(values: Column, n_windows: Column, window: int) -> Column:
    """The minimum of each of the first ``n_windows`` runs of ``window`` values, in order; runs behind each other with one minimum may share an entry.

    Runs that begin in one block of ``BLOCK`` values share the blocks between; mostly the minimum lies in these and is
    that of all of them.
    """
    if window % BLOCK or window < 2 * BLOCK:
        return F.slice(minima(values, window), F.lit(1), n_windows)
    inner = window // BLOCK - 1

    def found(at: Column) -> Column:
        values, blocks, between = at["values"], at["blocks"], at["between"]

        def one(own: Column, i: Column) -> Column:
            shared = F.get(between, i + 1)
            value = lambda j: F.get(values, i * BLOCK + j)
            each = F.array(*(F.least(shared, *(value(j + (0 if j >= first else window)) for j in range(BLOCK))) for first in range(BLOCK)))
            alike = F.least(own, F.get(blocks, i + (inner + 1))) > shared
            return F.when(alike, F.array(shared)).otherwise(F.slice(each, F.lit(1), F.least(at["n"] - i * BLOCK, F.lit(BLOCK))))

        return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.ceil(at["n"] / BLOCK).cast("int")), one))

    def blocked(values: Column) -> Column:
        block = lambda p: F.least(*(F.get(values, p + j) for j in range(BLOCK)))
        blocks = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK)), block)
        return let(blocks, lambda blocks: let(F.struct(
            values.alias("values"), blocks.alias("blocks"), minima(blocks, inner).alias("between"), n_windows.alias("n")), found))

    return let(values, blocked)


def selected(piece: Column, start: Column, n_windows: Column, k: int, window: int) -> Column:
    """(pos, hash) of the hashes that the first ``n_windows`` windows of a piece of text select.

    Characters take four bytes each, so a run of them is a slice. A window is decided by 31 bits of the
    hash and then by the place of the run's first byte, counted from 1 and packed with them into one number; what is
    kept is the whole hash.
    """
    byte = lambda v: F.negative(v).bitwiseAND(LOW_32).cast("int")

    def kept(letters: Column) -> Column:
        hashed = lambda b: F.xxhash64(F.substring(letters, b, F.lit(4 * k)))
        packed = lambda b: F.shiftleft(hashed(b).bitwiseAND(LOW_31), 32) - b
        last = F.greatest(F.octet_length(letters) - 4 * k, F.lit(0)) + 1
        found = lowest(F.transform(F.sequence(F.lit(1), last, F.lit(4)), packed), n_windows, window)
        return F.transform(F.array_distinct(found), lambda v: F.struct(
            (start + F.shiftright(byte(v) - 1, 2)).alias("pos"), hashed(byte(v)).alias("hash")))

    nothing = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(piece == "", nothing).otherwise(let(F.encode(piece, "UTF-32"), kept))


def fingerprint(text: Column, k: int = K, window: int = WINDOW, piece: int = PIECE) -> Column:
    """array<struct<pos, hash>> in order of position; positions count characters from 0.

    A text of fewer than ``k`` characters has the hash of all of it; an empty or null text has none. A text
    with fewer than ``window`` runs is one window.
    """

    def of(text: Column, windows: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((windows - 1) / piece).cast("int"))
        parts = F.transform(starts, lambda p: selected(
            F.substr(text, p * piece + 1, F.lit(piece + k + window - 2)), p * piece, F.least(windows - p * piece, F.lit(piece)), k, window))
        # Neighbouring pieces may select the same place.
        return let(F.flatten(parts), lambda all_: F.filter(all_, lambda x, i: (i == 0) | (x["pos"] != F.get(all_, i - 1)["pos"])))

    return let(F.coalesce(text, F.lit("")), lambda t: let(F.greatest(F.length(t) - (k + window - 2), F.lit(1)), lambda windows: of(t, windows)))


def of_windows(prints: Column, n: Column, window: int = WINDOW) -> Column:
    """Those of a text's ``prints`` that its first ``n`` windows select.

    A print was first selected by the window that it entered, if its hash is not above the one before, or else by
    the window that the one before has just left.
    """
    low = lambda x: x["hash"].bitwiseAND(LOW_31)

    def first(x: Column, i: Column, every: Column) -> Column:
        before = F.get(every, i - 1)
        return F.when(i == 0, 0).when(low(x) <= low(before), F.greatest(x["pos"] - (window - 1), F.lit(0))).otherwise(before["pos"] + 1)

    return let(n, lambda n: let(prints, lambda every: F.filter(every, lambda x, i: first(x, i, every) < n)))


def spliced(
    prints: Column, shared: Column, text: Column, k: int = K, window: int = WINDOW, piece: int = PIECE, behind: Column | None = None
) -> Column:
    """The fingerprint of a ``text`` that begins with the first ``shared`` characters of one with these ``prints``.

    What follows may be the beginning of a text with the prints ``behind``. Windows within either part select what they
    did before, so only those across the seam are walked, or, without ``behind``, all that are not within the first part.
    """
    span = k + window - 2       # characters of a window but one
    moved = lambda prints, by: F.transform(prints, lambda x: F.struct((x["pos"] + by).alias("pos"), x["hash"].alias("hash")))

    def joined(at: Column) -> Column:
        inside, length, shared, after = at["inside"], at["length"], at["shared"], at["after"]
        # A text shorter than a window is one; with a window before the seam, a rest without one of its own selects nothing.
        end = F.when(after > 0, shared).otherwise(F.greatest(length - span, F.when(inside > 0, inside).otherwise(1)))
        seam = F.when(end > inside, F.substr(text, inside + 1, end - inside + span)).otherwise("")
        every = [of_windows(prints, inside, window), moved(fingerprint(seam, k, window, piece), inside)]
        if behind is not None:
            every.append(moved(of_windows(behind, after, window), shared))
        every = F.concat(*every)
        return let(every, lambda every: F.filter(every, lambda x, i: (i == 0) | (x["pos"] != F.get(every, i - 1)["pos"])))

    length = F.length(text)
    # A column outside a lambda would be computed anew for every element within.
    return let(F.struct(
        F.greatest(shared - span, F.lit(0)).alias("inside"), length.alias("length"), shared.alias("shared"),
        (F.lit(0) if behind is None else F.greatest(length - shared - span, F.lit(0))).alias("after")), joined)


def as_text(prints: Column) -> Column:
    """``pos:hash`` of each entry, hashes in hexadecimal, with blanks between them."""
    return F.lower(F.array_join(F.transform(prints, lambda x: F.concat(x["pos"].cast("string"), F.lit(":"), F.hex(x["hash"]))), " "))


def hashes(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Shared among all distinct hashes of two fingerprints' hashes, from 0 to 1; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def with_next(documents: DataFrame, add) -> DataFrame:
    """Rows (doc_id, text, and what ``add`` gives) with ``next``, a struct of the row behind by descending id.

    Rows of one id follow each other by a hash of their text, null ids come last, and the row behind
    the last is the first; a single row is behind itself. Null texts are empty. Rows are dealt into
    ordered buckets by quantiles of their place, evenly split in between, and texts are shuffled once. The
    first row of each bucket also goes, as a guest, to the bucket before; there is one such row a bucket,
    so their list is as short as the list of buckets.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.bitwise_not(F.xxhash64("text")))
    # Falls along the order: by id, and within one id by the hash.
    place = F.col("doc_id").cast("double") + F.col("tie") / F.lit(2.0 ** 64)
    cuts = rows.agg(F.percentile_approx(place, [i / CUTS for i in range(CUTS + 1)], CUTS * 20)).first()[0] or [0.0]
    ends = F.array(*(F.lit(float(c)) for c in sorted(set(cuts))))
    finer = -(-PER_TASK * parts // CUTS)
    number = let(F.size(F.filter(ends, lambda c: c < place)), lambda i: i.cast("long") * finer + F.coalesce(F.least(
        F.floor((place - F.get(ends, i - 1)) / (F.get(ends, i) - F.get(ends, i - 1)) * finer), F.lit(finer - 1)), F.lit(0)))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(number))
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    order = Window.partitionBy().orderBy(F.desc("bucket"))
    before = F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("bucket", "head", before.alias("before"))
    rows = rows.join(F.broadcast(heads), "bucket")
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("tie") == F.col("head.tie"))
    at = lambda bucket, guest: F.struct(F.col(bucket).alias("bucket"), F.lit(guest).alias("guest"))
    places = F.when(first, F.array(at("bucket", False), at("before", True))).otherwise(F.array(at("bucket", False)))
    dealt = rows.select("doc_id", "text", "tie", F.explode(places).alias("at")).select("doc_id", "text", "tie", "at.*")
    made = add(dealt.repartition(parts, "bucket"))
    behind = Window.partitionBy("bucket").orderBy("guest", F.desc("doc_id"), F.desc("tie"))
    kept = [c for c in made.columns if c not in ("tie", "bucket", "guest")]
    return made.withColumn("next", F.lead(F.struct(*kept)).over(behind)).where(~F.col("guest")).select(*kept, "next")


def third(text: Column) -> Column:
    return F.floor(F.length(text) / 3).cast("int")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by the first characters of the text that follows."""
    return F.concat(F.substr(text, F.lit(1), F.length(text) - third(text)), F.substr(following, F.lit(1), third(text)))


def fingerprints(documents: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``documents``: doc_id, n_chars, prints, next_prints, and the same of an edited text.

    ``prints`` are those of the whole text, ``edited`` is the text with its last third replaced by the
    beginning of the next document, ``edited_prints`` are of that. Null texts are empty; empty texts have no
    prints. Other columns of the input are ignored; repeated ids and rows keep their number.
    """
    rows = with_next(documents, lambda df: df.withColumn("prints", fingerprint(F.col("text"), k, window)))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next.text")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "prints", F.col("next.prints").alias("next_prints"),
        spliced(F.col("prints"), F.length("text") - third(F.col("text")), F.col("edited"), k, window, behind=F.col("next.prints")).alias("edited_prints"))


def digests(documents: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints as text, and how alike they are to the edited text's and to the next document's."""
    rows = fingerprints(documents, k, window)
    rows = rows.select(
        "*", hashes(F.col("prints")).alias("own"), hashes(F.col("edited_prints")).alias("changed"), hashes(F.col("next_prints")).alias("other"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"))
