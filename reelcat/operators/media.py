"""Newest media per folder and the renames it implies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.functions.text import file_stem, is_media_file, media_name
from reelcat.operators.dedup import keep_last

# Fixed value: the name a browser download lands under before it is renamed.
DEFAULT_DOWNLOAD_NAME = "videoplayback.mp4"


def latest_media(inventory: DataFrame, folder: Sequence[str] = ("subject_name", "quality_dir"),
                 mtime: str = "modification_time") -> DataFrame:
    """A9 (S9): per folder, the newest ``.mp4`` (any case); ties go to the greater name.

    ``max_by`` aggregates with map-side partials, so a folder with a third of
    all files still moves one candidate per task.
    """
    media = inventory.where(is_media_file("filename", case_sensitive=False))
    return media.groupBy(*folder).agg(
        F.max_by("filename", F.struct(F.col(mtime), F.col("filename"))).alias("latest_file"),
        F.max(mtime).alias("latest_mtime"),
    )


def held_by_id(inventory: DataFrame, order: str = "path") -> DataFrame:
    """A10: ``file_id -> subject``, the last listed file wins (ordered by path)."""
    files = inventory.select(file_stem("filename").alias("file_id"), "subject_name", F.col(order))
    return keep_last(files, "file_id", order).select("file_id", "subject_name")


def rename_plan(latest_flat: DataFrame, current: DataFrame) -> DataFrame:
    """(from, to) renames for each subject's newest flat file.

    ``latest_flat`` has (subject_name, latest_file); ``current`` has the video
    just fetched per subject (subject_name, id, title). The newest file is
    renamed to ``{id}.mp4`` unless its name equals the expected name (the title,
    compared as is). A file still named ``videoplayback.mp4`` is renamed too.
    """
    j = latest_flat.join(current, "subject_name")
    newest = j.where(F.col("latest_file") != F.col("title")).select(
        "subject_name", F.col("latest_file").alias("from_name"), media_name("id").alias("to_name"),
        F.lit("newest").alias("rule"),
    )
    return newest


def default_name_renames(files: DataFrame, current: DataFrame) -> DataFrame:
    """A subject's ``videoplayback.mp4`` becomes ``{id}.mp4`` of its current video."""
    dl = files.where(F.col("filename") == F.lit(DEFAULT_DOWNLOAD_NAME)).select("subject_name").distinct()
    return dl.join(current, "subject_name").select(
        "subject_name", F.lit(DEFAULT_DOWNLOAD_NAME).alias("from_name"), media_name("id").alias("to_name"),
        F.lit("default_name").alias("rule"),
    )
