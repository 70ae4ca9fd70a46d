"""The download status ledger and attempt outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER_KEY = ("subject_name", "video_id")


def upsert_ledger(ledger: DataFrame, batch: DataFrame, keys: Sequence[str] = LEDGER_KEY,
                  order: str = "ledger_pos") -> DataFrame:
    """Apply a status batch to a ledger, as record-by-record updates would.

    Keys present in the ledger get the batch's title and status on every ledger
    row with that key, in place (their position stays). New keys are appended
    at the position of their first batch row, with the values of their last.
    The write key is (subject, id) while lookups (J2) use (subject, id, title):
    a renamed video reads as found until its row is updated, as in the source.
    """
    keys = list(keys)
    # last values and first position per key: one aggregate with map-side partials
    latest = batch.groupBy(*keys).agg(
        F.max_by(F.struct("video_title", "is_link_found"), F.col(order)).alias("_v"),
        F.min(order).alias("_first_pos"),
    )
    upd = latest.select(*[F.col(k).alias(f"_n_{k}") for k in keys], "_v", "_first_pos")
    cond = None
    for k in keys:
        c = ledger[k] == upd[f"_n_{k}"]
        cond = c if cond is None else cond & c
    old = ledger.join(upd, cond, "left").select(
        *keys,
        F.when(F.col("_v").isNotNull(), F.col("_v.video_title")).otherwise(F.col("video_title")).alias("video_title"),
        F.when(F.col("_v").isNotNull(), F.col("_v.is_link_found")).otherwise(F.col("is_link_found")).alias("is_link_found"),
        F.col(order),
    )
    new = latest.join(ledger.select(*keys), keys, "left_anti").select(
        *keys, F.col("_v.video_title").alias("video_title"), F.col("_v.is_link_found").alias("is_link_found"),
        F.col("_first_pos").alias(order),
    )
    return old.unionByName(new)


def in_ledger(rows: DataFrame, ledger: DataFrame, keys: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """Rows whose key already has a ledger row (left semi join)."""
    return rows.join(ledger.select(*keys), list(keys), "left_semi")


def attempt_outcome(attempts: DataFrame) -> DataFrame:
    """A video counts as downloaded when any attempt succeeded."""
    return attempts.groupBy("video_id").agg(
        F.bool_or("success").alias("is_downloaded"), F.count(F.lit(1)).alias("n_attempts")
    )


def status_batch_from_pages(pages_for_videos: DataFrame, failure_col: str = "is_failure") -> DataFrame:
    """C6 input: one status row per visited video, found unless its page shows the failure block."""
    return pages_for_videos.select(
        "subject_name", "video_id", "video_title", (~F.col(failure_col)).alias("is_link_found"), "ledger_pos"
    )
