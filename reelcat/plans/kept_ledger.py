"""J4/K5 kept up to date: a status ledger in cells, of which a batch rewrites only those it touches.

``record_status`` writes a whole new ledger for every batch. Here the ledger lies in cells of
(subject, part of its ids): a batch for one subject reads and rewrites ``parts`` cells at most, and
a subject with a third of all rows still spreads over as many files and tasks. The versions
are those of ``sinks.kept``.

Every batch has a number; one that was merged before is left out, so a batch may be sent again
after a failure. Rows, repeated keys and positions come out as ``upsert_ledger`` gives them
for the whole ledger. Rows with a null subject or id have a cell, but never meet a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.operators.ledger import upsert_ledger
from reelcat.session import stage_table, staging_scope
from reelcat.sinks import kept
from reelcat.streaming.ledger import STATUS_SCHEMA

COLUMNS = ("subject_name", "video_id", "video_title", "is_link_found", "ledger_pos")

#: Parts that a subject's ids are dealt to; fixed, as a kept ledger's cells depend on it.
PARTS = 8


def _cells(rows: DataFrame, number: int) -> DataFrame:
    subject = F.pmod(F.xxhash64("subject_name"), F.lit(number // PARTS))
    cell = subject * PARTS + F.pmod(F.xxhash64("video_id"), F.lit(PARTS))
    return rows.select(*COLUMNS, cell.cast("int").alias("bucket"))


def merge_status(spark: SparkSession, base: str, batch: DataFrame, number: int, subjects: int = 64) -> dict:
    """Apply status batch ``number`` (J4); returns how many ``cells`` it touched and how many the ledger has.

    ``subjects`` (groups that subjects are hashed to) counts for the first write, later ones
    keep its value: size it so that a cell of the ledger fits a task.
    """
    last = kept.current_version(spark, base)
    if number in last.merged:
        return {"cells": 0, "of": len(last.placed)}
    cells, placed = last.buckets or subjects * PARTS, dict(last.placed)
    with staging_scope(spark):
        fresh = stage_table(_cells(batch, cells), "status-batch")
        touched = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}  # numbers below `cells`
        if touched:
            old = kept.read_buckets(spark, base, STATUS_SCHEMA, {c: f for c, f in placed.items() if c in touched})
            merged = _cells(upsert_ledger(old, fresh.select(*COLUMNS)), cells)
            placed |= dict.fromkeys(touched, kept.write_buckets(merged.repartition("bucket"), base))
    kept.commit_version(spark, base, kept.KeptVersion(cells, last.merged | {number}, placed))
    return {"cells": len(touched), "of": len(placed)}


def start_ledger(spark: SparkSession, base: str, ledger: DataFrame, subjects: int = 64) -> None:
    """Keep an existing ledger, row by row as it is (repeated keys too), before the first batch."""
    if kept.current_version(spark, base).buckets:
        raise ValueError(f"{base} holds a ledger already")
    cells = subjects * PARTS
    folder = kept.write_buckets(_cells(ledger, cells).repartition("bucket"), base)
    there = spark.read.parquet(f"{base}/{folder}").select("bucket").distinct().collect() if ledger.take(1) else []
    kept.commit_version(spark, base, kept.KeptVersion(cells, frozenset(), dict.fromkeys((r["bucket"] for r in there), folder)))


def kept_status(spark: SparkSession, base: str) -> DataFrame:
    """The ledger as of the batches merged so far; a scan without a shuffle."""
    return kept.read_buckets(spark, base, STATUS_SCHEMA, kept.current_version(spark, base).placed)
