"""Build download manifests from selected videos.

A manifest is kept as rows (one per video, keyed by id, with ``subject_name``)
plus a per-subject header. The single JSON object the reference writes per
manifest is produced only at the edge, by ``reelcat.sinks.manifest`` as sorted
text lines, so no subject is ever collected into one row or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.functions.text import ALL_VIDEOS_SENTENCE, na_fill, subject_from_catalog_name, subject_from_channel
from reelcat.operators.dedup import dedup_videos, keep_last
from reelcat.operators.select import MATCH_LIKE, MATCH_LITERAL, any_term, select_videos
from reelcat.schemas import NA_FIELDS, RECORD_FIELDS

MANIFEST_FIELDS = RECORD_FIELDS + ("subject_name",)


def manifest_rows(selected: DataFrame, order: Sequence[str] = ("entry_pos",)) -> DataFrame:
    """A1 -> P3 -> P4: one row per id (last wins), ``NA`` fill, ``@channel`` subject."""
    latest = dedup_videos(selected, order)
    cols = [na_fill(c).alias(c) if c in NA_FIELDS else F.col(c) for c in RECORD_FIELDS]
    return latest.select(*cols, subject_from_channel("youtuber").alias("subject_name"))


def select_manifest(videos: DataFrame, channel: str | None = None, terms: Sequence[str] | None = None,
                    match: str = MATCH_LIKE, order: Sequence[str] = ("entry_pos",)) -> DataFrame:
    """C3 core: F5 selection -> A1 -> P3/P4."""
    return manifest_rows(select_videos(videos, channel, terms, match), order)


def search_terms_value(terms: Sequence[str] | None):
    """The header's ``search_terms``: the list, or the fixed sentence when there is none."""
    return list(terms) if terms else ALL_VIDEOS_SENTENCE


def manifest_summary(rows: DataFrame, terms: Sequence[str] | None = None) -> DataFrame:
    """A4 + A11: per subject the number of distinct ids, with the header's terms.

    ``search_terms`` is null when the header holds the "all videos" sentence.
    """
    header = F.array(*[F.lit(t) for t in terms]) if terms else F.lit(None).cast("array<string>")
    return rows.groupBy("subject_name").agg(F.count_distinct("id").alias("n_videos")).withColumn("search_terms", header)


# ---------------------------------------------------------------- C4 (catalog reduction)


def reduce_catalog_rows(catalog_rows: DataFrame, terms: Sequence[str] | None = None,
                        order: Sequence[str] | None = None) -> DataFrame:
    """C4: per catalog file, videos whose title holds a term (literal), with subject.

    ``catalog_rows`` has ``catalog_file`` and the record fields. Ids are unique within a
    written catalog, so nothing is shuffled; for rows that repeat one, ``order`` names
    the columns by which the last wins (as when a JSON object repeats a key). The subject
    comes from the file name (P7); the filter is a literal substring match (F3),
    or none without terms (F4).
    """
    per_file = keep_last(catalog_rows, ["catalog_file", "id"], list(order)) if order else catalog_rows
    if terms:
        per_file = per_file.where(any_term("title", list(terms), MATCH_LITERAL))
    return per_file.select(
        "catalog_file", *RECORD_FIELDS, subject_from_catalog_name("catalog_file").alias("subject_name")
    )
