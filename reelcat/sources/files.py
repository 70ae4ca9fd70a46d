"""JDBC, catalogs, manifests, status ledgers, media inventories, stored pages."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelcat.functions.text import CATALOG_SUFFIX, decoded_path, path_basename
from reelcat.schemas import CATALOG_SCHEMA, LEDGER_SCHEMA, MANIFEST_SCHEMA, PAGE_SCHEMA, RECORD_FIELDS
from reelcat.session import staging_path

# CSV as pandas writes and reads it: quotes doubled, line breaks inside quotes, blanks kept.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

CATALOG_ROW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RECORD_FIELDS]
    + [T.StructField("entry_pos", T.LongType(), True), T.StructField("catalog_file", T.StringType(), True)]
)


def read_catalog_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3/S4 (row form): catalogs written by ``write_catalog_rows``; ``catalog_file`` from the folder."""
    return spark.read.schema(CATALOG_ROW_SCHEMA).option("basePath", path).format(fmt).load(path)


def _visible(spark: SparkSession, path: str, glob: str) -> str:
    """``path``, or a staged copy of its catalogs under visible names if some begin with ``_`` or ``.``.

    Spark skips such files. The copy goes through the Hadoop file system API, file by
    file, and puts ``c`` before every name (an import edge: one file is one JSON object).
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    found, listing = [], fs.listFiles(top, True)
    while listing.hasNext():
        p = listing.next().getPath()
        if fnmatch.fnmatchcase(p.getName(), glob):
            found.append(p)
    if not any(p.getName()[0] in "_." for p in found):
        return path
    to = staging_path(spark, "catalog-files")
    for k, p in enumerate(found):
        target = jvm.org.apache.hadoop.fs.Path(jvm.org.apache.hadoop.fs.Path(f"{to}/{k}"), "c" + p.getName())
        if not jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, target.getFileSystem(conf), target, False, conf):
            raise OSError(f"could not copy {p}")
    return to


def read_catalog_documents(spark: SparkSession, path: str, glob: str = f"*{CATALOG_SUFFIX}") -> DataFrame:
    """S3/S4 (document form): every ``*_VideosObject.json`` under ``path`` as rows.

    One file is one JSON object, so each file is read by one task (the format
    cannot be split; prefer the row form). Repeated keys in an object: last wins
    (this sets ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` on the session). Names that
    begin with ``_``, as the usual catalogs' do, are read through a staged copy.
    """
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    at = _visible(spark, path, glob)
    name = decoded_path("_metadata.file_name")
    docs = (spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).option("pathGlobFilter", glob if at == path else "c" + glob)
            .option("recursiveFileLookup", True).json(at)
            .select((name if at == path else F.substr(name, F.lit(2))).alias("catalog_file"), "videos"))
    exploded = docs.select("catalog_file", F.explode("videos").alias("key", "v"))
    return exploded.select("catalog_file", *[F.col(f"v.{c}").alias(c) for c in RECORD_FIELDS])


def read_manifest_documents(spark: SparkSession, path: str) -> DataFrame:
    """Manifest documents as rows (id, record fields, subject_name, search_terms text)."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    docs = (spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
            .select(decoded_path("_metadata.file_path").alias("manifest_file"), "search_terms", "videos"))
    rows = docs.select("manifest_file", "search_terms", F.explode("videos").alias("key", "v"))
    return rows.select("manifest_file", "search_terms",
                       *[F.col(f"v.{c}").alias(c) for c in RECORD_FIELDS], F.col("v.subject_name").alias("subject_name"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Status ledger CSVs under ``<base>/<subject>/download_status.csv``.

    Explicit string/boolean schema (no inference: numeric-looking ids stay text,
    ``NA`` stays text; titles with quotes, line breaks or edge blanks come back whole). A missing path reads as an empty ledger. The subject is
    the ledger file's parent folder name; the row's place in its file is
    (``ledger_file``, ``ledger_offset``, ``ledger_pos``): pass all three as the
    order of ``status_lookup`` / ``upsert_ledger`` for exact first-row semantics.
    """
    schema = LEDGER_SCHEMA
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        empty = spark.createDataFrame([], schema)
        return empty.select(F.lit(None).cast("string").alias("subject_name"), *schema.fieldNames(),
                            F.lit(None).cast("string").alias("ledger_file"), F.lit(None).cast("long").alias("ledger_offset"),
                            F.lit(None).cast("long").alias("ledger_pos"))
    df = (spark.read.schema(schema).options(**CSV_OPTIONS).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "download_status.csv").csv(path))
    file = decoded_path("_metadata.file_path")
    return df.select(
        path_basename(F.regexp_replace(file, "/[^/]*$", "")).alias("subject_name"),
        *schema.fieldNames(),
        file.alias("ledger_file"),
        F.col("_metadata.file_block_start").alias("ledger_offset"),
        F.monotonically_increasing_id().alias("ledger_pos"),
    )


def read_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Media files under ``<base>/<subject>/[<quality>/]<name>``.

    Uses the ``binaryFile`` source but selects only metadata (path, time,
    length); the file content column is pruned from the scan.
    """
    base = base.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
             .select("path", "modificationTime", "length"))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape_regex(base.split(":", 1)[-1]) + "/", "")
    parts = F.split(rel, "/")
    n = F.size(parts)
    return files.select(
        F.col("path"),
        F.element_at(parts, 1).alias("subject_name"),
        F.when(n == 3, F.element_at(parts, 2)).alias("quality_dir"),
        F.element_at(parts, -1).alias("filename"),
        F.col("modificationTime").alias("modification_time"),
        F.col("length"),
        n.alias("depth"),
    ).where(F.col("depth").isin(2, 3))


def _escape_regex(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def read_videos_jdbc(spark: SparkSession, url: str, table: str = "videos", partition_column: str | None = None,
                     lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
                     properties: dict | None = None) -> DataFrame:
    """The ``videos`` table over JDBC, split on a numeric column when given.

    Filters are applied as Columns afterwards; Spark pushes simple ones into the
    database's WHERE clause (no SQL text is assembled from user input).
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored result pages ``(page_id, url, html)`` (Parquet or JSON Lines)."""
    if fmt == "parquet":
        return spark.read.parquet(path).select(*PAGE_SCHEMA.fieldNames())
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)
