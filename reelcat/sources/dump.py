"""Scan record dumps.

A dump is UTF-8 text whose records end with the three characters ``\\_/``.
The text source splits on that terminator directly, so a dump is read by many
tasks in parallel (Hadoop's line reader handles records that cross a split).
Entry order is kept as (file path, split start, position in split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.functions.grammar import RECORD_TERMINATOR
from reelcat.functions.text import decoded_path

# Columns that order entries as the dump's producer read them.
ORDER_COLUMNS = ("source_file", "source_offset", "source_seq")


def read_dump(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Raw entries: ``value`` plus file name and order columns.

    ``source_seq`` must be taken right at the scan: it is increasing within a
    split, and (path, split start) orders the splits.
    """
    reader = spark.read.option("lineSep", RECORD_TERMINATOR).option("wholetext", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path)
    partition_cols = [c for c in raw.columns if c != "value"]  # from key=value folders, if any
    return raw.select(
        F.col("value"),
        *partition_cols,
        decoded_path("_metadata.file_name").alias("source_name"),
        decoded_path("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_offset"),
        F.monotonically_increasing_id().alias("source_seq"),
    )
