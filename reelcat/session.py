"""Session construction and the shared staging folder.

Everything that has to cut lineage or land an intermediate file goes under the
folder named by ``spark.checkpoint.dir``: on a cluster that is a shared,
fault-tolerant file system, so a lost executor never loses staged data. A local
temporary folder is only used when the session names none and runs in one
process (``local[...]``, unit tests); any other master without a folder is refused.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "reelcat") -> SparkSession:
    """A local session for tests and the bench: AQE on, UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only on measured sizes: no static (estimated) broadcast joins;
        # AQE turns a join into a broadcast once the shuffled side's real size is known
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("REELCAT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when it is unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="reelcat-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def staging_root(spark: SparkSession) -> str:
    """This application's staging folder: ``<checkpoint dir>/reelcat-staging/<application id>``."""
    base = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not base:
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/reelcat-staging/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under this application's staging folder for one staged dataset."""
    return "/".join([staging_root(spark), *_SCOPES, f"{name}-{uuid.uuid4().hex[:12]}"])


#: The staging scopes entered, outermost first (a driver-side stack).
_SCOPES: list[str] = []


@contextlib.contextmanager
def staging_scope(spark: SparkSession):
    """What is staged inside is deleted at the end: for jobs that write their own output."""
    _SCOPES.append(f"scope-{uuid.uuid4().hex[:12]}")
    path = "/".join([staging_root(spark), *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.pop()
        _delete(spark, path)


_KEPT: dict[tuple[str, str], str] = {}


@contextlib.contextmanager
def renewed_scope(spark: SparkSession, name: str):
    """What is staged inside stays until the next scope of this name is entered.

    For steps that return DataFrames over staged tables, each written out before the
    next step begins: one step's staged tables at most are on disk.
    """
    key = (spark.sparkContext.applicationId, name)
    if key in _KEPT:
        _delete(spark, _KEPT.pop(key))
    _SCOPES.append(f"{name}-{uuid.uuid4().hex[:12]}")
    _KEPT[key] = "/".join([staging_root(spark), *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.pop()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def drop_staging(spark: SparkSession) -> None:
    """Delete this application's staging folder (call when its jobs are done)."""
    _delete(spark, staging_root(spark))


#: Rows up to which a staged table of short columns is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def sized(staged):
    """A staged narrow table, marked for broadcast only if its counted rows are few."""
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else staged


def spread(scan):
    """A table's scan over all tasks there are, if its files make fewer partitions (a file of one row group is one task else).

    For scans under work that costs much more a row than moving it; a table of many splits is left as it is.
    """
    tasks = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan._jdf.queryExecution().toRdd().getNumPartitions() >= tasks else scan.repartition(tasks)


def stage_table(df, name: str):
    """Write ``df`` as Parquet under the shared staging folder and read it back.

    Cuts lineage (a lost executor recomputes nothing upstream) and lets several
    consumers share one computation, with column pruning on the reads.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
