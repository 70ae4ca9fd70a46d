"""S7/S9/A9 kept up to date: snapshots of the media folders, compared with the last listing.

A refresh lists the folders (names, times and lengths; contents are not read) and joins the listing with the
last snapshot by path. A file is ``added``, ``removed``, or ``changed`` if its time or length
is another. Files lie in cells of (folder, part of its paths), so that a folder with a
third of all files spreads over ``PARTS`` of them; only cells with a change are rewritten, and with
them their candidates for the folder's newest file (A9). The versions are those of ``sinks.kept``.

A folder is a subject with its quality folder, if any. An empty or emptied base gives an
empty snapshot and ``removed`` rows. One refresh at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.operators.media import latest_media
from reelcat.session import stage_table, staging_scope
from reelcat.sinks import kept
from reelcat.sources.files import read_inventory

FILE = "path string, subject_name string, quality_dir string, filename string, modification_time timestamp, length long"
COLUMNS = ("path", "subject_name", "quality_dir", "filename", "modification_time", "length")
CANDIDATE = "subject_name string, quality_dir string, latest_file string, latest_mtime timestamp"
CHANGE = FILE + ", change string, refresh long"

#: Parts that a folder's paths are dealt to; fixed, as a kept snapshot's cells depend on it.
PARTS = 8


def _cells(files: DataFrame, number: int) -> DataFrame:
    folder = F.pmod(F.xxhash64("subject_name", "quality_dir"), F.lit(number // PARTS))
    cell = folder * PARTS + F.pmod(F.xxhash64("path"), F.lit(PARTS))
    return files.select(*COLUMNS, cell.cast("int").alias("bucket"))


def refresh_inventory(spark: SparkSession, media: str, base: str, folders: int = 64) -> dict:
    """List ``media`` and keep the result; returns the numbers of files ``added``, ``changed``, ``removed`` and of ``cells`` rewritten.

    ``folders`` (groups that folders are hashed to) counts for the first refresh, later ones keep its value.
    """
    last = kept.current_version(spark, base)
    cells, placed, refresh = last.buckets or folders * PARTS, dict(last.placed), 1 + max(last.merged, default=0)
    with staging_scope(spark):
        now = stage_table(_cells(read_inventory(spark, media), cells), "listing")
        before = _cells(kept.read_buckets(spark, f"{base}/files", FILE, placed), cells)
        new, old = F.struct("n.modification_time", "n.length"), F.struct("o.modification_time", "o.length")
        both = now.alias("n").join(before.alias("o"), F.col("n.path") == F.col("o.path"), "full_outer")
        change = F.when(F.col("o.path").isNull(), "added").when(F.col("n.path").isNull(), "removed").when(new != old, "changed")
        diff = stage_table(both.select(*[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in (*COLUMNS, "bucket")], change.alias("change"))
                           .where("change IS NOT NULL"), "listing-changes")
        counts = {r["change"]: r["count"] for r in diff.groupBy("change").count().collect()}
        touched = {r["bucket"] for r in diff.select("bucket").distinct().collect()}  # numbers below `cells`
        if touched:
            renewed = now.where(F.col("bucket").isin(sorted(touched)))
            filled = {r["bucket"] for r in renewed.select("bucket").distinct().collect()}
            folder = kept.write_buckets(renewed.repartition("bucket"), f"{base}/files")
            newest = latest_media(renewed, ("bucket", "subject_name", "quality_dir"))
            newest.withColumn("placed", F.lit(folder)).write.parquet(f"{base}/newest/{folder}")
            placed = {c: f for c, f in placed.items() if c not in touched} | dict.fromkeys(filled, folder)
        numbered = diff.drop("bucket").withColumn("refresh", F.lit(refresh).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{base}/changes/{refresh}")  # a failed refresh may have left some
    kept.commit_version(spark, base, kept.KeptVersion(cells, last.merged | {refresh}, placed))
    return {c: counts.get(c, 0) for c in ("added", "changed", "removed")} | {"cells": len(touched)}


def kept_files(spark: SparkSession, base: str) -> DataFrame:
    """The files of the last refresh, as ``read_inventory`` lists them (without ``depth``)."""
    return kept.read_buckets(spark, f"{base}/files", FILE, kept.current_version(spark, base).placed)


def kept_newest(spark: SparkSession, base: str) -> DataFrame:
    """A9 from the kept candidates: each folder's newest media file, of at most ``PARTS`` candidates a folder."""
    placed = kept.current_version(spark, base).placed
    if not placed:
        return spark.createDataFrame([], CANDIDATE)
    found = spark.read.schema(CANDIDATE + ", bucket int, placed string").parquet(*[f"{base}/newest/{f}" for f in sorted(set(placed.values()))])
    current = spark.createDataFrame(sorted(placed.items()), "bucket int, placed string")  # one row a cell
    return found.join(F.broadcast(current), ["bucket", "placed"], "left_semi").groupBy("subject_name", "quality_dir").agg(
        F.max_by("latest_file", F.struct("latest_mtime", "latest_file")).alias("latest_file"), F.max("latest_mtime").alias("latest_mtime"))


def inventory_changes(spark: SparkSession, base: str) -> DataFrame:
    """Every change that a refresh found, with the refresh's number; those of a failed refresh are not seen."""
    done = sorted(kept.current_version(spark, base).merged)
    return spark.read.schema(CHANGE).parquet(*[f"{base}/changes/{n}" for n in done]) if done else spark.createDataFrame([], CHANGE)
