"""K1, K2, K3, K4, K5: writers for videos, catalogs, manifests and the ledger.

Row forms (Parquet / JSON Lines, partitioned by their natural key) are what the
engine reads back. Single-object JSON documents are an edge format, written by
``reelcat.sinks.documents``.
"""

from __future__ import annotations

import itertools
import json
import threading
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from reelcat.schemas import RECORD_FIELDS
from reelcat.sinks.documents import JSON_OPTIONS, document_lines, json_string, write_documents
from reelcat.session import staging_scope
from reelcat.sources.files import CSV_OPTIONS


def _text_heavy(writer: DataFrameWriter, fmt: str) -> DataFrameWriter:
    """Parquet of whole descriptions is written as zstd, which takes about two thirds of the default's bytes; other formats as they are."""
    return (writer.option("compression", "zstd") if fmt == "parquet" else writer).format(fmt)


def write_videos(videos: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                 jdbc_options: dict | None = None) -> None:
    """K1: append parsed videos, partitioned by channel (or to a JDBC table).

    Appends are not idempotent (the source dumps may repeat ids); readers dedup
    with A1 over the stored entry order.
    """
    if fmt == "jdbc":
        w = videos.write.format("jdbc").mode(mode)
        for k, v in (jdbc_options or {}).items():
            w = w.option(k, v)
        w.save()
        return
    _text_heavy(videos.write.mode(mode).partitionBy("youtuber"), fmt).save(path)


def write_catalog_rows(catalog_rows: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """K2 (row form): catalog videos, one folder per catalog file (Parquet, or ``fmt="json"``).

    Folder names are ``catalog_file=<name>``, so names starting with ``_`` stay
    visible to readers that skip hidden files. The single-object JSON form of a
    catalog is ``catalog_documents``.
    """
    cols = ["catalog_file", *RECORD_FIELDS] + [c for c in ("entry_pos",) if c in catalog_rows.columns]
    _text_heavy(catalog_rows.select(*cols).write.mode(mode).partitionBy("catalog_file"), fmt).save(path)


def catalog_documents(videos: DataFrame, urls: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """K2 (document form): ``{"videos": {id: record}, "urls": {url: id}}`` per catalog file.

    The sections fill independently: ``videos`` holds one row per (catalog_file, id)
    (A1), ``urls`` one per (catalog_file, webpage_url) (A2). ``names`` (catalog_file)
    lists the catalogs to write, also those without a row.
    """
    rec = F.to_json(F.struct(*RECORD_FIELDS), JSON_OPTIONS)
    by_id = videos.select("catalog_file", F.col("id").alias("key"), rec.alias("value_json"))
    by_url = urls.select("catalog_file", F.col("webpage_url").alias("key"), json_string(F.col("id")).alias("value_json"))
    return document_lines("catalog_file", [("videos", by_id), ("urls", by_url)], names)


def manifest_header_json(terms: Sequence[str] | None) -> str:
    """The header text of a manifest document (ends with a comma)."""
    from reelcat.operators.manifest import search_terms_value

    return f'"search_terms": {json.dumps(search_terms_value(terms), ensure_ascii=False)},'


def manifest_documents(rows: DataFrame, terms: Sequence[str] | None, doc_col: str = "manifest_name",
                       names: DataFrame | None = None) -> DataFrame:
    """K3: ``{"search_terms": .., "videos": {id: record + subject_name}}`` per manifest.

    ``names`` (doc_col) lists the manifests to write, also those without a row.
    """
    rec = F.to_json(F.struct(*RECORD_FIELDS, "subject_name"), JSON_OPTIONS)
    videos = rows.select(doc_col, F.col("id").alias("key"), rec.alias("value_json"))
    return document_lines(doc_col, [("videos", videos)], names, manifest_header_json(terms))


def write_manifest_documents(rows: DataFrame, terms: Sequence[str] | None, path: str, doc_col: str = "manifest_name",
                             mode: str = "errorifexists", names: DataFrame | None = None) -> None:
    with staging_scope(rows.sparkSession):
        write_documents(manifest_documents(rows, terms, doc_col, names), doc_col, path, mode)


#: One reservation at a time in this process; between processes the file system's create without overwrite decides.
_RESERVING = threading.Lock()


def reserve(spark: SparkSession, folder: str, name: str) -> bool:
    """Take ``name`` in ``folder`` by creating ``folder/_taken/<name>`` without overwrite; false if it was taken before.

    One call to the file system, which lets one of several writers through (on HDFS and on stores
    with a conditional create; a local file system of several processes only checks first).
    """
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_taken/{name}")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with _RESERVING:
        try:
            fs.create(marker, False).close()
        except Py4JJavaError as e:
            if fs.exists(marker):
                return False
            raise e
    return True


def unique_path(spark: SparkSession, folder: str, base_name: str, extension: str = "") -> str:
    """K4: ``folder/base_name{ext}``, or ``base_name_2``, ``_3`` ... if taken (never overwrite).

    The name is reserved (``reserve``), so writers that ask at the same time get different ones;
    a path that is there without a reservation counts as taken. Pair with ``mode("errorifexists")``.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n in itertools.count(1):
        name = f"{base_name}{f'_{n}' if n > 1 else ''}{extension}"
        candidate = f"{folder.rstrip('/')}/{name}"
        if not fs.exists(path(candidate)) and reserve(spark, folder, name):
            return candidate


def _versions(spark: SparkSession, base: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version=") and name[8:].isdigit():
            out.append(int(name[8:]))
    return sorted(out)


def write_ledger_version(spark: SparkSession, ledger: DataFrame, base: str, fmt: str = "csv") -> str:
    """K5: write the ledger as ``base/version=<n+1>`` (the version being read stays intact)."""
    versions = _versions(spark, base)
    path = f"{base.rstrip('/')}/version={(versions[-1] + 1) if versions else 1}"
    write_ledger(ledger, path, fmt)
    return path


def current_ledger_path(spark: SparkSession, base: str) -> str | None:
    """The newest complete ledger version under ``base`` (None when there is none).

    A version counts once its writer committed (``_SUCCESS`` present), so a
    reader never sees a half-written ledger: writing the next version is the switch.
    """
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in reversed(_versions(spark, base)):
        path = f"{base.rstrip('/')}/version={v}"
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")):
            return path
    return None


def write_ledger(ledger: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """K5: write a new ledger version (never the path being read), one folder per subject."""
    out = ledger.select("subject_name", "video_id", "video_title", "is_link_found",
                        *[c for c in ("ledger_pos",) if c in ledger.columns])
    w = out.write.mode(mode).partitionBy("subject_name")
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    else:
        w.format(fmt).save(path)
