"""A1/A2 kept up to date: a table of the last row per key, into which only new runs are merged.

``jobs.committed_videos`` dedups every row of every run on each read. Here the last
rows are kept by hash bucket of the key under ``<videos>/_latest/<key>``; a merge reads the runs
that were committed since (their files alone hold the run's number, so that the filter on it
skips the others by their statistics) and the buckets that these touch, and writes those buckets
anew. Nothing is changed in place: a version lists the folder of each bucket and the runs merged,
and counts once its writer committed, so a reader or a failed merge never sees half of one.

One merge of a table at a time (the second of two fails, as its version exists). Runs may commit in any
order: kept rows carry their run. Null keys are one group, as in A1. Folders that the current
version doesn't name can be deleted once no reader of an older version is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.operators.dedup import keep_last
from reelcat.plans.jobs import INGEST_ORDER, INGESTED, _ingested, ingest_log
from reelcat.session import sized, stage_table, staging_scope
from reelcat.sinks import kept

#: What a key's table keeps of a row: all of it (A1), or the index entry (A2).
KEPT = {"id": INGESTED, "webpage_url": "source_file string, source_offset long, source_seq long, id string, webpage_url string, ingest_run long"}


#: Rows of a merge from which a key's are reduced to the last one before the exchange.
HOT_ROWS = 1000


def _base(videos_path: str, key: str) -> str:
    return f"{videos_path.rstrip('/')}/_latest/{key}"


def _hot_reduced(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows``, of each key that more than ``HOT_ROWS`` of them share only the last; whole rows aren't shuffled for it.

    The hot keys come from a count, and their last rows' order from their key and order columns.
    """
    hot = stage_table(rows.groupBy(key).count().where(F.col("count") > HOT_ROWS).select(F.col(key).alias("_hot")), "latest-hot")
    if hot.isEmpty():
        return rows
    shared = rows.select(key, *order).join(sized(hot), F.col(key).eqNullSafe(F.col("_hot")), "left_semi")
    last = stage_table(keep_last(shared, key, order).select(F.col(key).alias("_hot"), F.struct(*order).alias("_last")), "latest-hot-last")
    marked = rows.join(sized(last), F.col(key).eqNullSafe(F.col("_hot")), "left")
    return marked.where(F.col("_last").isNull() | (F.struct(*order) == F.col("_last"))).select(*rows.columns)


def merge_latest(spark: SparkSession, videos_path: str, key: str = "id", buckets: int = 64) -> dict:
    """Merge the runs committed since the last merge; returns how many ``runs`` were new and how many ``buckets`` were written.

    ``buckets`` counts for the first merge, later ones keep its number: size it so that a bucket
    of the distinct keys fits a task. A key that many new rows share is reduced before the exchange,
    the only one that whole rows go through; nothing but keys and order columns is staged.
    """
    base = _base(videos_path, key)
    last = kept.current_version(spark, base)
    number = last.buckets or buckets
    committed = {r["ingest_run"] for r in ingest_log(spark, videos_path).select("ingest_run").distinct().collect()}
    runs = sorted(committed - last.merged)
    if not runs:
        return {"runs": 0, "buckets": 0}
    bucket = F.pmod(F.xxhash64(key), F.lit(number)).cast("int").alias("bucket")
    order, columns = list(INGEST_ORDER), spark.createDataFrame([], KEPT[key]).columns
    placed = dict(last.placed)
    with staging_scope(spark):
        rows = _ingested(spark, videos_path).where(F.col("ingest_run").isin(runs)).select(*columns)
        touched = {r["bucket"] for r in rows.select(bucket).distinct().collect()}
        old = {b: folder for b, folder in placed.items() if b in touched}
        every = _hot_reduced(rows, key, order).select("*", bucket)
        every = every.unionByName(kept.read_buckets(spark, base, KEPT[key], old).select("*", bucket)) if old else every
        if touched:  # whole rows go through one exchange, by bucket, which serves the window and the files
            placed |= dict.fromkeys(touched, kept.write_buckets(keep_last(every.repartition("bucket"), ["bucket", key], order), base))
    kept.commit_version(spark, base, kept.KeptVersion(number, last.merged | committed, placed))
    return {"runs": len(runs), "buckets": len(touched)}


def kept_latest(spark: SparkSession, videos_path: str, key: str = "id") -> DataFrame:
    """The last row of each ``key`` over the runs merged so far; a scan without a shuffle."""
    base = _base(videos_path, key)
    return kept.read_buckets(spark, base, KEPT[key], kept.current_version(spark, base).placed)


def kept_url_index(spark: SparkSession, videos_path: str) -> DataFrame:
    """A2/J5 from the kept table: ``webpage_url -> id``."""
    return kept_latest(spark, videos_path, "webpage_url").select("webpage_url", "id")
