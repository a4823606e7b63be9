"""Keyed upsert and update on plain files: the store is read, merged and written as a new version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import schemas
from sievework.session import cut_lineage

# The columns a second arrival of a notice does not touch.
NOTICE_PRESERVED = (
    "bid", "notification_sent", "notification_sent_at", "created_at",
    "ml_processed", "ml_bid", "ml_confidence", "ml_reasoning", "ml_status",
)


def latest_by_key(df: DataFrame, key: str, order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: the one that arrived last. Partial aggregation keeps a hot key cheap."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    picked = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def filter_new_records(incoming: DataFrame, stored: DataFrame, key: str = "resource_id") -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(key), key, "left_anti")


def last_values(updates: DataFrame, key: str, columns: Sequence[str], arrival: str | Sequence[str] | None) -> DataFrame:
    """One row per key with the ``columns`` of its last arrival.

    Delivery is at least once, so keys repeat. Without an arrival only equal repeats may occur, such
    as marks that carry no value of their own; they fall together.
    """
    if arrival is None:
        return updates.select(key, *columns).distinct()
    order = [arrival] if isinstance(arrival, str) else list(arrival)
    kept = updates.select(key, *dict.fromkeys([*columns, *order]))
    return latest_by_key(kept, key, order).select(key, *columns)


def update_by_key(
    target: DataFrame,
    updates: DataFrame,
    arrival: str | Sequence[str] | None,
    key: str = "resource_id",
    columns: Sequence[str] | None = None,
    stamp: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Overwrite ``columns`` of the rows whose key is in ``updates``; of equal keys the last arrival counts.

    A left join with one row per key: no row of the store is repeated, and Spark sends small
    ``updates`` to the tasks, so that the wide store is not shuffled.
    """
    columns = list(columns or [c for c in updates.columns if c != key])
    new = last_values(updates, key, columns, arrival)
    new = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(new, key, "left")
    values = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    for c, value in (stamp or {}).items():
        values[c] = F.when(F.col("_hit"), value).otherwise(F.col(c))
    kinds = dict(target.dtypes)
    return joined.select(*[values[c].cast(kinds[c]).alias(c) if c in values else F.col(c) for c in target.columns])


def unmatched_updates(target: DataFrame, updates: DataFrame, key: str = "resource_id") -> DataFrame:
    """Updates whose key the store does not know."""
    known = target.select(key).join(updates.select(key), key, "left_semi")
    return updates.join(known, key, "left_anti")


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    order_by: str | Sequence[str],
    key: str = "resource_id",
    preserve: Sequence[str] = (),
    stamp: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert unknown keys, overwrite known ones except their ``preserve`` columns.

    The last arrival of a key by ``order_by`` wins; applying the same batch twice gives the same store.
    The batch is reduced and written once, then met with the store twice; the store is moved at most
    once, and not at all while the batch is small enough for a broadcast.
    """
    batch = cut_lineage(latest_by_key(incoming, key, order_by))
    names = target.columns
    updated = [c for c in names if c in batch.columns and c != key and c not in preserve]
    merged = update_by_key(target, batch, order_by, key, updated, stamp) if updated else target
    fresh = unmatched_updates(target, batch, key)
    kinds = dict(target.dtypes)
    stamps = stamp or {}
    rows = fresh.select(*[
        (stamps[c] if c in stamps else F.col(c) if c in batch.columns else F.lit(None)).cast(kinds[c]).alias(c)
        for c in names
    ])
    return merged.unionByName(rows)


def upsert_notices(stored: DataFrame, incoming: DataFrame, order_by: str) -> DataFrame:
    """Notices: labels, notification marks and predictions of known rows stay."""
    batch = schemas.align_schema(incoming, schemas.NOTICES, schemas.NOTICE_DEFAULTS)
    if order_by not in batch.columns:
        raise ValueError(f"no arrival column {order_by}")
    return upsert(stored, batch, order_by, preserve=[c for c in NOTICE_PRESERVED if c in stored.columns])


def upsert_doc_content(stored: DataFrame, texts: DataFrame, now: Column, order_by: str) -> DataFrame:
    """Document texts: every column is replaced, the status is COMPLETED."""
    batch = texts.withColumns({
        "extraction_timestamp": now,
        "processing_status": F.lit("COMPLETED"),
        "codes_count": F.size("detected_codes"),
    })
    return upsert(stored, batch, order_by)


def upsert_summaries(stored: DataFrame, summaries: DataFrame, now: Column, order_by: str) -> DataFrame:
    """Summaries: the first ``created_at`` stays, ``updated_at`` is stamped."""
    return upsert(stored, summaries, order_by, preserve=["created_at"], stamp={"updated_at": now})


def update_predictions(notices: DataFrame, predictions: DataFrame, now: Column, arrival: str) -> DataFrame:
    """Write a decision back."""
    columns = ["ml_bid", "ml_confidence", "ml_reasoning", "ml_status"]
    return update_by_key(notices, predictions, arrival, columns=columns,
                         stamp={"ml_processed": F.lit(True), "updated_at": now})


def update_status(notices: DataFrame, statuses: DataFrame, arrival: str) -> DataFrame:
    """Write only the status back."""
    return update_by_key(notices, statuses, arrival, columns=["ml_processed", "ml_status"])


def mark_notified(notices: DataFrame, sent: DataFrame, now: Column) -> DataFrame:
    """Set the notification mark of the given keys, however often they are given."""
    return update_by_key(notices, sent.select("resource_id", F.lit(True).alias("notification_sent")), None,
                         stamp={"notification_sent_at": now})


def label_value(answer: Column | str) -> Column:
    """y/yes is 1, n/no is 0, anything else NULL."""
    word = F.lower(F.trim(F.col(answer) if isinstance(answer, str) else answer))
    return F.when(word.isin("y", "yes"), 1).when(word.isin("n", "no"), 0)


def apply_labels(notices: DataFrame, answers: DataFrame, arrival: str, answer: str = "answer") -> DataFrame:
    """Set labels from a table of answers; unclear answers change nothing, of clear ones the last counts."""
    labels = answers.withColumn("bid", label_value(answer)).where(F.col("bid").isNotNull())
    return update_by_key(notices, labels, arrival, columns=["bid"])
