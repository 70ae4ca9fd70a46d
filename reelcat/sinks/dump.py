"""Write record dumps (the inverse of S1), e.g. to exchange data with tools that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.functions.grammar import RECORD_TERMINATOR, render_record
from reelcat.schemas import RECORD_FIELDS


def dump_lines(videos: DataFrame) -> DataFrame:
    """One ``value`` per record: a newline, then ``| f1 | ... | f8 `` (terminator added on write)."""
    return videos.select(F.concat(F.lit("\n"), render_record(*RECORD_FIELDS)).alias("value"))


def write_dump(lines: DataFrame, path: str, order_by: list | None = None, mode: str = "errorifexists",
               partition_by: list[str] | None = None) -> None:
    """Write ``value`` rows, each followed by the terminator.

    With ``order_by`` the rows are range-partitioned and sorted first, so the part
    files, read in name order, hold the records in that order. ``partition_by``
    puts each value (e.g. the channel) in its own folder.
    """
    parts = list(partition_by or [])
    out = lines.orderBy(*parts, *order_by) if order_by else lines
    w = out.select(*parts, "value").write.mode(mode).option("lineSep", RECORD_TERMINATOR)
    if parts:
        w = w.partitionBy(*parts)
    w.text(path)
