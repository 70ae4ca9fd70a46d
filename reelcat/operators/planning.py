"""Turn a manifest into a download work list.

The reference answers these per record (a dict lookup, a CSV re-read, a scan of
a folder listing); here each is one join over all records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.functions.numbers import status_flag, tolerant_duration
from reelcat.functions.text import file_stem, is_media_file
from reelcat.operators.dedup import keep_first
from reelcat.operators.substring import DEFAULT_ANCHOR, rows_with_contained_needle
from reelcat.session import stage_table

HIGH_QUALITY_DIR = "HighQuality"


def held_ids(inventory: DataFrame) -> DataFrame:
    """S7 -> P14: ids of media already held (``HighQuality``, ``.mp4``), one row each."""
    hq = inventory.where((F.col("quality_dir") == F.lit(HIGH_QUALITY_DIR)) & is_media_file("filename"))
    # distinct first: partial aggregation, so a hot id never lands whole in one task
    return hq.select(file_stem("filename").alias("file_id")).distinct()


def anti_held(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Drop videos whose id is held in any subject; null ids are kept."""
    held = held_ids(inventory)
    return manifest.join(held, manifest["id"] == held["file_id"], "left_anti")


def status_lookup(manifest: DataFrame, ledger: DataFrame, order: str | list[str] = "ledger_pos") -> DataFrame:
    """J2 + P18: the first ledger row per (subject, id, title); no row means found.

    ``order`` is the ledger's row order (one column or several, e.g. file, offset, row).
    """
    first = keep_first(ledger, ["subject_name", "video_id", "video_title"], order).select(
        F.col("subject_name").alias("_l_subj"), F.col("video_id").alias("_l_id"),
        F.col("video_title").alias("_l_title"), F.col("is_link_found").alias("_l_flag"),
    )
    cond = ((F.col("subject_name") == F.col("_l_subj")) & (F.col("id") == F.col("_l_id"))
            & (F.col("title") == F.col("_l_title")))
    joined = manifest.join(first, cond, "left")
    return joined.select(*manifest.columns, status_flag("_l_flag").alias("is_link_found"))


def gate_on_status(rows: DataFrame) -> DataFrame:
    """drop work whose recorded status is 'link not found'."""
    return rows.where(F.col("is_link_found"))


def flat_media(inventory: DataFrame) -> DataFrame:
    """Media files directly in a subject folder (not in a quality folder)."""
    return inventory.where(F.col("quality_dir").isNull() & is_media_file("filename"))


def skip_substring(manifest: DataFrame, inventory: DataFrame, anchor: int = DEFAULT_ANCHOR) -> DataFrame:
    """Drop videos whose id or title occurs inside a file name of their subject."""
    manifest = stage_table(manifest, "work")  # read twice: for its needles, and for the anti join
    files = flat_media(inventory)
    # both needles of a row from one pass over the manifest
    needles = manifest.select("subject_name", "id", F.explode(F.array("id", "title")).alias("needle"))
    hits = rows_with_contained_needle(needles, files, ["subject_name", "id"], anchor=anchor, needles_staged=True)
    cond = manifest["subject_name"].eqNullSafe(hits["subject_name"]) & manifest["id"].eqNullSafe(hits["id"])
    return manifest.join(hits, cond, "left_anti")


def download_plan(manifest: DataFrame, inventory: DataFrame, ledger: DataFrame,
                  ledger_order: str | list[str] = "ledger_pos") -> DataFrame:
    """Manifest -> J1 -> J2 -> F11 -> J3 = videos still to fetch."""
    kept = anti_held(manifest, inventory)
    with_status = gate_on_status(status_lookup(kept, ledger, ledger_order))
    return skip_substring(with_status.drop("is_link_found"), inventory)


def duration_totals(manifest: DataFrame) -> DataFrame:
    """A5 + P16: duration goal per subject and overall (the rollup row has a null subject)."""
    return (
        manifest.rollup("subject_name")
        .agg(F.sum(tolerant_duration("duration")).alias("duration_total"),
             F.count(F.lit(1)).alias("n_videos"))
    )


def distinct_subjects(manifest: DataFrame) -> DataFrame:
    """Subjects named in the manifest (non-null)."""
    return manifest.where(F.col("subject_name").isNotNull()).select("subject_name").distinct()


def first_subjects(manifest: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` subjects in name order (a top-k: the limit is the feature)."""
    return distinct_subjects(manifest).orderBy("subject_name").limit(n)
