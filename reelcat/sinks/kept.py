"""Tables kept by hash bucket, of which a merge rewrites only the buckets that it touches.

``<base>/data/<folder>/bucket=<n>`` holds rows, ``<base>/versions/version=<n>`` names each bucket's
folder and the merges made so far. Nothing is changed in place, and a version counts once its
writer committed: neither a reader nor a failed merge ever sees half of one. One merge at a time:
of two that begin from one version, the second fails, as its version exists. Folders that the
newest version doesn't name can be deleted once nobody reads an older one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from reelcat.sinks.tables import _versions, current_ledger_path

VERSION = "kind string, number long, folder string"


@dataclass(frozen=True)
class KeptVersion:
    """Number of buckets, merges made, and each bucket's folder: a few numbers a bucket and merge."""

    buckets: int | None = None
    merged: frozenset = frozenset()
    placed: dict = field(default_factory=dict)


def current_version(spark: SparkSession, base: str) -> KeptVersion:
    path = current_ledger_path(spark, f"{base}/versions")
    rows = spark.read.schema(VERSION).parquet(path).collect() if path else []
    return KeptVersion(next((r["number"] for r in rows if r["kind"] == "buckets"), None),
                       frozenset(r["number"] for r in rows if r["kind"] == "run"),
                       {r["number"]: r["folder"] for r in rows if r["kind"] == "bucket"})


def read_buckets(spark: SparkSession, base: str, schema: str, placed: dict) -> DataFrame:
    paths = [f"{base}/{folder}/bucket={b}" for b, folder in sorted(placed.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_buckets(rows: DataFrame, base: str) -> str:
    """Write ``rows`` by their ``bucket`` column to a new folder, whose name is returned."""
    folder = f"data/{uuid.uuid4().hex}"
    rows.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{base}/{folder}")  # whole texts
    return folder


def commit_version(spark: SparkSession, base: str, version: KeptVersion) -> None:
    lines: Iterable = [("buckets", version.buckets, None), *[("run", r, None) for r in sorted(version.merged)],
                       *[("bucket", b, f) for b, f in sorted(version.placed.items())]]
    after = max(_versions(spark, f"{base}/versions"), default=0) + 1
    spark.createDataFrame(lines, VERSION).coalesce(1).write.mode("errorifexists").parquet(f"{base}/versions/version={after}")
