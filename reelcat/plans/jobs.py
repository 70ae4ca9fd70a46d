"""The user-level jobs, each a composition of DataFrame operators.

Jobs that produce several outputs from one input stage the input once (a
written table under the shared checkpoint folder) instead of scanning twice,
and never overwrite the path they read.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelcat.functions.text import catalog_name_from_dump, manifest_base_name, manifest_name_from_input
from reelcat.operators import ledger as ledger_ops
from reelcat.operators import manifest as manifest_ops
from reelcat.operators import media as media_ops
from reelcat.operators import planning
from reelcat.operators.dedup import keep_last
from reelcat.operators.pages import PageSpec, extract_page_fields
from reelcat.operators.parse import STATUS_PARSED, classify_entries, load_counters, load_metrics, parsed_rows, rejected_rows
from reelcat.schemas import VIDEOS_STORED
from reelcat.session import stage_table, staging_scope
from reelcat.sinks import tables as sinks
from reelcat.sinks.documents import write_documents
from reelcat.sources.dump import ORDER_COLUMNS, read_dump
from reelcat.sources.files import read_catalog_rows
from reelcat.streaming.ledger import read_ledger_version


INGEST_ORDER = ("ingest_run", *ORDER_COLUMNS)
LEDGER_FILE_ORDER = ["ledger_file", "ledger_offset", "ledger_pos"]
INGESTED = VIDEOS_STORED.replace(", youtuber string", ", ingest_run long, youtuber string")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _ingested(spark: SparkSession, videos_path: str) -> DataFrame:
    return spark.read.schema(INGESTED).parquet(videos_path)


def ingest_dump(spark: SparkSession, dump_path: str, videos_path: str, rejects_path: str | None = None,
                channel: str | None = None, compat: bool = False, glob: str | None = None) -> dict:
    """Dump -> parse -> ``videos`` (appended, by channel) + rejects; returns the load counters.

    Appends are not idempotent (as in the source); each run gets the number after
    the last one stored, so ``latest_videos`` can dedup on read, last entry wins.
    Counters are taken while the videos are written; rejects are a second, narrow pass.
    """
    run = 1 + ((_ingested(spark, videos_path).agg(F.max("ingest_run")).first()[0] or 0) if _exists(spark, videos_path) else 0)
    classified = classify_entries(read_dump(spark, dump_path, glob), compat=compat, channel=channel)
    seen = Observation(f"ingest-{uuid.uuid4().hex}")
    counted = classified.observe(seen, F.sum("chars").alias("chars"), *load_counters())
    sinks.write_videos(parsed_rows(counted).withColumn("ingest_run", F.lit(run).cast("long")), videos_path, mode="append")
    if rejects_path:
        rejected_rows(classified).write.mode("append").json(rejects_path)
    stored = _ingested(spark, videos_path).where(F.col("ingest_run") == run)
    distinct = stored.agg(F.count_distinct("id").alias("distinct_ids"), F.count_distinct("webpage_url").alias("distinct_urls"))
    return seen.get | distinct.first().asDict()


INGEST_LOG = "path string, length long, modificationTime timestamp, ingest_run long"


def ingest_log(spark: SparkSession, videos_path: str) -> DataFrame:
    """(path, length, modificationTime, ingest_run) of the dump files whose rows are committed in ``videos_path``."""
    log = f"{videos_path}/_ingested/files"
    return spark.read.schema(INGEST_LOG).parquet(log) if _exists(spark, log) else spark.createDataFrame([], INGEST_LOG)


def ingest_new(spark: SparkSession, dump_path: str | list[str], videos_path: str, channel: str | None = None, compat: bool = False,
               glob: str | None = None) -> dict:
    """C1, idempotent: only dump files that no committed run has read are read (by path, length and modification time).

    The files are listed without their contents and anti-joined with the log before any is read; a
    run's number is reserved in the log's folder, without a look at the stored rows. The log is
    written last: rows of a run that failed before stay invisible to ``committed_videos``, and
    its files are read again. Returns the load counters, with ``files`` read (0: nothing was new).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = (reader.option("pathGlobFilter", glob) if glob else reader).load(dump_path).select("path", "length", "modificationTime")
    fresh = listed.join(ingest_log(spark, videos_path), ["path", "length", "modificationTime"], "left_anti").orderBy("path").collect()  # names, as a reader needs them
    if not fresh:
        return {"files": 0}
    run = next(n for n in itertools.count(1) if sinks.reserve(spark, f"{videos_path}/_ingested", f"run-{n}"))
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in fresh]  # as they are, not as patterns
    seen = Observation(f"ingest-{uuid.uuid4().hex}")
    counted = classify_entries(read_dump(spark, paths), compat=compat, channel=channel).observe(seen, F.sum("chars").alias("chars"), *load_counters())
    sinks.write_videos(parsed_rows(counted).withColumn("ingest_run", F.lit(run).cast("long")), videos_path, mode="append")
    rows = spark.createDataFrame([(*r, run) for r in fresh], INGEST_LOG)
    rows.coalesce(1).write.mode("append").parquet(f"{videos_path}/_ingested/files")
    return seen.get | {"files": len(fresh)}


def committed_videos(spark: SparkSession, videos_path: str) -> DataFrame:
    """The rows of committed runs (``ingest_new``), the last entry of each id (A1)."""
    runs = ingest_log(spark, videos_path).select("ingest_run").distinct()
    return keep_last(_ingested(spark, videos_path).join(F.broadcast(runs), "ingest_run", "left_semi"), "id", list(INGEST_ORDER))


def latest_videos(spark: SparkSession, videos_path: str) -> DataFrame:
    """A1 on read: one row per id over every ingest run, the last entry wins (order: ``INGEST_ORDER``)."""
    return keep_last(_ingested(spark, videos_path), "id", list(INGEST_ORDER))


def build_catalog(spark: SparkSession, dump_path: str, out_path: str, glob: str | None = None,
                  documents_path: str | None = None, rejects_path: str | None = None) -> dict:
    """Dump -> parse -> per catalog (named from the dump file, P6): last video per id (A1).

    The row form goes to ``out_path``. The single-object JSON form (optionally, to
    ``documents_path``) fills its ``videos`` by id (A1) and its ``urls`` by URL (A2/J5)
    independently, from all entries; a dump without a record gives an empty catalog.
    No channel is needed. Returns the load counters.
    """
    order = list(ORDER_COLUMNS)
    with staging_scope(spark):
        named = classify_entries(read_dump(spark, dump_path, glob), channel_from_name=False).withColumn(
            "catalog_file", catalog_name_from_dump(F.col("source_file")))
        entries = stage_table(named.drop("youtuber"), "catalog")
        rows = entries.where(F.col("entry_status") == STATUS_PARSED)
        per_id = keep_last(rows, ["catalog_file", "id"], order)
        sinks.write_catalog_rows(per_id, out_path)
        if documents_path:
            per_url = keep_last(rows, ["catalog_file", "webpage_url"], order)
            lines = sinks.catalog_documents(per_id, per_url, entries.select("catalog_file").distinct())
            write_documents(lines, "catalog_file", documents_path)
        if rejects_path:
            rejected_rows(entries).write.json(rejects_path)
        return load_metrics(entries).first().asDict()


def select_videos(spark: SparkSession, videos: DataFrame, out_folder: str, channel: str | None = None,
                  terms: Sequence[str] | None = None, order: Sequence[str] = ("entry_pos",)) -> str:
    """F5 selection -> A1 -> P3/P4 -> manifest written under a fresh name (P11 + K4), also without a hit."""
    rows = manifest_ops.select_manifest(videos, channel, terms, order=order)
    name = manifest_base_name(channel, list(terms) if terms else None)
    path = sinks.unique_path(spark, out_folder, name)
    names = spark.range(1).select(F.lit(name).alias("manifest_name"))
    sinks.write_manifest_documents(rows.withColumn("manifest_name", F.lit(name)), terms, path, names=names)
    return path


def reduce_catalogs(spark: SparkSession, catalogs_path: str, out_folder: str,
                    terms: Sequence[str] | None = None, name: str = "reduced") -> str:
    """C4: every catalog -> literal-term filter -> manifest per catalog (P7, P8, P12), also without a hit.

    The manifests go to a fresh folder (K4) under ``out_folder``, whose path is returned;
    rows without a catalog name go to the manifest of ``None``.
    """
    catalogs = read_catalog_rows(spark, catalogs_path)
    rows = manifest_ops.reduce_catalog_rows(catalogs, terms)
    path = sinks.unique_path(spark, out_folder, name)
    named = manifest_name_from_input(F.coalesce("catalog_file", F.lit("None"))).alias("manifest_name")
    sinks.write_manifest_documents(rows.withColumn("manifest_name", named), terms, path, names=catalogs.select(named).distinct())
    return path


def plan_downloads(manifest: DataFrame, inventory: DataFrame, ledger: DataFrame,
                   ledger_order: str | list[str] = "ledger_pos") -> dict[str, DataFrame]:
    """The work list, plus the duration goal (A5) and the subjects.

    For ledgers read from CSV pass ``ledger_order=LEDGER_FILE_ORDER``.
    """
    return {
        "work": planning.download_plan(manifest, inventory, ledger, ledger_order),
        "durations": planning.duration_totals(manifest),
        "subjects": planning.distinct_subjects(manifest),
        "first_subjects": planning.first_subjects(manifest),
    }


def record_status(spark: SparkSession, ledger: DataFrame, batch: DataFrame, out_path: str) -> DataFrame:
    """Apply a status batch (J4) and write the new ledger version (K5); returns it as stored."""
    updated = ledger_ops.upsert_ledger(ledger, batch)
    sinks.write_ledger(updated, out_path)
    return read_ledger_version(spark, out_path)


def plan_renames(inventory: DataFrame, current: DataFrame) -> DataFrame:
    """(from, to) renames, one per subject at most.

    A subject's newest flat file becomes ``{id}.mp4`` of its current video unless its
    name is as expected; where that rule has nothing to do, a leftover default name
    does. A file that has its name already is left, and so is one whose target exists.
    """
    flat = inventory.where(F.col("quality_dir").isNull())
    newest = media_ops.rename_plan(media_ops.latest_media(flat), current)
    default = media_ops.default_name_renames(flat, current)
    plan = newest.unionByName(default.join(newest.select("subject_name"), "subject_name", "left_anti"))
    taken = flat.select("subject_name", F.col("filename").alias("to_name"))
    return plan.join(taken, ["subject_name", "to_name"], "left_anti").select(*newest.columns)


def page_fields(pages: DataFrame, spec: PageSpec = PageSpec()) -> DataFrame:
    """Links, markers, label and file name of every page."""
    return extract_page_fields(pages, spec)
