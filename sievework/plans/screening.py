"""The jobs a screening run is made of, each from DataFrames to DataFrames.

Batch runs and stream batches call the same functions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework import fixed_values as fv
from sievework.functions import clean, reply
from sievework.operators import scoring, upsert
from sievework.operators.lexicon import Lexicon
from sievework.session import cut_lineage
from sievework.sources import store

Detector = Callable[..., DataFrame]     # such as a CodeDetector


def ingest(raw: DataFrame, stored: DataFrame, arrival: str) -> tuple[DataFrame, DataFrame]:
    """Raw rows to (the merged store, the notices that are new to it with their route).

    Keys are typed first, since different texts may give one key; of several rows with one key the last
    by ``arrival`` counts.
    """
    typed = cut_lineage(upsert.latest_by_key(clean.type_records(raw, [arrival]), "resource_id", arrival))
    merged = upsert.upsert_notices(stored, typed, arrival)
    return merged, store.route_by_url(upsert.filter_new_records(typed, stored).drop(arrival))


def document_features(docs: DataFrame, detect: Detector, lexicon: Lexicon | None = None) -> DataFrame:
    """Codes and counts of each text, without the text, which stays in its scan."""
    return detect(docs, keep=partial(scoring.doc_features, lexicon=lexicon))


def screen(
    notices: DataFrame,
    docs: DataFrame,
    detect: Detector,
    lexicon: Lexicon | None = None,
    authorities: Mapping[str, int] | None = None,
    threshold: float = fv.RULE_THRESHOLD,
    review_threshold: float = fv.REVIEW_THRESHOLD,
) -> DataFrame:
    """Every notice with its codes, decision, reason, next stage and review queue.

    The only join moves counts; the texts stay where they are read.
    """
    rows = notices.join(document_features(docs, detect, lexicon), "resource_id", "left")
    scored = scoring.predict_rule(rows, lexicon, authorities, threshold)
    staged = scored.withColumn("processing_stage", next_stage())
    return scoring.review_category(staged, "ml_confidence", review_threshold)


def next_stage(min_bytes: int = 100) -> Column:
    """Title-only without URL or with hardly any text, else scoring."""
    no_url = F.coalesce(F.col("pdf_url"), F.lit("")) == ""
    short = F.coalesce(F.col("trimmed_bytes"), F.lit(0)) < min_bytes
    return F.when(no_url | short, "ai_summary_title_only").otherwise("ml_prediction")


def notify(
    replies: DataFrame, notices: DataFrame, now: Column, link_base: str, recipients: Column, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Replies to (summaries to store, digests to send, one per recipient).

    ``replies`` has ``resource_id``, ``reply``, ``summary_type`` and the prediction
    (``should_bid``, ``confidence``, ``reasoning``).
    """
    summaries = reply.with_notify_note(reply.normalize_reply(replies), strict)
    wanted = summaries.where("notify").join(notices, "resource_id")
    digests = reply.digest_rows(reply.notify_payload(wanted, now, link_base), link_base)
    texts = digests.withColumn("digest", reply.digest_text())
    return summaries, reply.notification_fanout(texts, recipients)
