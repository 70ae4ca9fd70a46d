"""Exact deduplication by Grace hash: partition by hash until a bucket fits, then compare whole contents.

1. *Combine*: each task runs its rows through an open-addressing table that compares
   complete contents and writes one representative per distinct text it met (a full
   table is written out and begun anew, which bounds its memory). A text copied over a
   third of all rows thus leaves one representative per task.
2. *Partition*: representatives are dealt to buckets by hash bits. Bytes are counted by
   bucket, and buckets over ``bucket_bytes`` are split again by further bits, until each
   fits or holds a single hash. The shuffle by leaf bucket writes the spill files.
3. *Compare*: one open-addressing table per leaf bucket settles the classes, and a narrow
   join hands the verdict to every row.

Equality: identical after lower-casing A-Z. Null counts as empty. The row with the largest
id stays (null ids are smallest; of rows equal in id and text, one). An empty table gives
an empty result; input columns travel in one struct, so their names don't matter.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reelcat.llm.common import as_bytes, ascii_lower, packed, small_batches, table, whole
from reelcat.session import stage_table, staging_path

LOWEST = -(1 << 63)
SPLIT_BITS = 4


class OpenTable:
    """Open addressing with linear probing; a slot names an entry, equality is of whole contents."""

    def __init__(self, size: int = 1 << 10):
        self.slots = [-1] * size
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.n_bytes = 0

    def entry(self, h: int, content: bytes) -> int:
        """The entry that equals ``content``; a new one (the highest number) if there is none."""
        slots, hashes, contents = self.slots, self.hashes, self.contents
        mask = len(slots) - 1
        i = h & mask
        while (e := slots[i]) >= 0:
            if hashes[e] == h and contents[e] == content:
                return e
            i = (i + 1) & mask
        slots[i] = len(hashes)
        hashes.append(h)
        contents.append(content)
        self.n_bytes += len(content) + 64
        if 2 * len(hashes) > len(slots):
            self._grow()
        return len(hashes) - 1

    def _grow(self) -> None:
        size = 2 * len(self.slots)
        self.slots = slots = [-1] * size
        for e, h in enumerate(self.hashes):
            i = h & (size - 1)
            while slots[i] >= 0:
                i = (i + 1) & (size - 1)
            slots[i] = e


def _contents(rows: pa.StructArray, text: str):
    """The normalised contents of a batch, one at a time."""
    off, raw = as_bytes(pc.fill_null(pc.struct_field(rows, [text]), ""))
    off = off.tolist()
    for a, b in zip(off, off[1:]):
        yield raw[a:b].tobytes().lower()  # of bytes, lower() changes A-Z only


def _combine(schema: pa.Schema, text: str, table_bytes: int):
    """Rows (h, id, text_sha256, row) to one member each, and a representative per local class."""

    def run(batches):
        made = TaskContext.get().partitionId() << 36
        classes, tab = [], OpenTable()  # of each class: rows, best id, its place in the class, its row

        def representatives():
            for at in range(0, len(classes), 64):
                some = classes[at : at + 64]
                rows = pa.concat_batches([x[3] for x in some])
                n = len(some)
                yield pa.RecordBatch.from_arrays([
                    pa.array(["rep"] * n), pa.array(range(made + at, made + at + n), pa.int64()), pa.array([x[2] for x in some], pa.int64()),
                    pa.array([x[0] for x in some], pa.int64()), rows["id"], rows["text_sha256"], rows["h"], rows["row"]], schema=schema)

        for batch in small_batches(batches):
            cls, place, best = [], [], {}
            for k, (h, i, content) in enumerate(zip(batch["h"].to_pylist(), batch["id"].to_pylist(), _contents(batch["row"], text))):
                e = tab.entry(h, content)
                if e == len(classes):
                    classes.append([0, None, 0, None])
                c = classes[e]
                if c[1] is None or i > c[1]:
                    c[1], c[2], best[e] = i, c[0], k
                cls.append(made + e)
                place.append(c[0])
                c[0] += 1
            taken = batch.take(pa.array(list(best.values()), pa.int64()))
            for at, e in enumerate(best):
                classes[e][3] = taken.slice(at, 1)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(["member"] * n), pa.array(cls, pa.int64()), pa.array(place, pa.int64()), pa.nulls(n, pa.int64()), batch["id"],
                batch["text_sha256"], pa.nulls(n, pa.int64()), pa.nulls(n, schema.field("row").type)], schema=schema)
            if tab.n_bytes > table_bytes:
                yield from representatives()
                made += len(classes)
                classes, tab = [], OpenTable()
        yield from representatives()

    return run


def _compare(schema: pa.Schema, text: str, with_rows: bool):
    """A leaf bucket's representatives to (cls, keep_id, group_size, place, row): the verdict on each local class.

    ``place`` (and ``row``) are set for the class that holds the row that stays.
    """

    def run(batches):
        tab, found = OpenTable(), []  # of each text: rows, best (id, -cls), its place, its row, all local classes
        for batch in small_batches(batches):
            best = {}
            for k, (h, i, c, n, p, content) in enumerate(zip(*(batch[x].to_pylist() for x in ("h", "id", "cls", "n", "place")),
                                                             _contents(batch["row"], text))):
                e = tab.entry(h, content)
                if e == len(found):
                    found.append([0, None, 0, None, []])
                f = found[e]
                f[0] += n
                f[4].append(c)
                if f[1] is None or (i, -c) > f[1]:
                    f[1], f[2], best[e] = (i, -c), p, k
            if with_rows and best:
                taken = batch.select(["row"]).take(pa.array(list(best.values()), pa.int64()))
                for at, e in enumerate(best):
                    found[e][3] = taken.slice(at, 1)
        none = pa.nulls(1, schema.field("row").type) if with_rows else None
        for at in range(0, len(found), 64):
            some = found[at : at + 64]
            flat = [(c, f[1][0], f[0], f[2] if c == -f[1][1] else None, f) for f in some for c in f[4]]
            cols = [pa.array([x[j] for x in flat], pa.int64()) for j in range(4)]
            if with_rows:
                cols.append(pa.concat_arrays([none if x[3] is None else x[4][3]["row"] for x in flat]))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def leaf_buckets(reps: DataFrame, size: DataFrame, bucket_bytes: int):
    """(expression of a representative's leaf bucket, number of leaves).

    ``size`` is (h, b). Level by level, the bytes of every bucket are summed; only the
    numbers of the buckets that are too large, and hold more than one hash, come to the driver.
    """
    total = size.agg(F.sum("b")).first()[0] or 0
    bits = max(0, int(-(-2 * total // bucket_bytes) - 1).bit_length())
    leaf = F.pmod("h", F.lit(1 << bits))
    leaves, fresh, used = 1 << bits, 1 << bits, bits
    while used + SPLIT_BITS <= 60:  # the leaves of the last level are the ``fresh`` highest numbers
        sums = size.groupBy(leaf.alias("leaf")).agg(F.sum("b").alias("b"), F.min("h").alias("low"), F.max("h").alias("top"))
        large = sums.where((F.col("leaf") >= leaves - fresh) & (F.col("b") > bucket_bytes) & (F.col("low") < F.col("top")))
        numbers = sorted(r[0] for r in large.select("leaf").collect())
        if not numbers:
            break
        child = F.pmod(F.shiftright("h", used), F.lit(1 << SPLIT_BITS))
        order = F.array_position(F.lit(numbers), leaf) - 1
        leaf = F.when(leaf.isin(numbers), leaves + order * (1 << SPLIT_BITS) + child).otherwise(leaf)
        fresh = len(numbers) << SPLIT_BITS
        leaves, used = leaves + fresh, used + SPLIT_BITS
    return leaf, leaves


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", with_rows: bool = False,
                bucket_bytes: int = 64 << 20, table_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """(members, verdicts).

    members, a row for each input row: id, text_sha256, keep_id, group_size, kept.
    verdicts: with ``with_rows``, ``row`` holds the input row of each text that stays, else null.
    """
    spark = docs.sparkSession
    norm = ascii_lower(whole(F.col(f"row.`{text}`")))
    df = packed(docs).select(F.xxhash64(norm).alias("h"), F.coalesce(F.col(f"row.`{key}`").cast("long"), F.lit(LOWEST)).alias("id"),
                             F.sha2(norm, 256).alias("text_sha256"), "row")
    row_type = df.schema["row"].dataType.simpleString()
    out = f"kind string, cls bigint, place bigint, n bigint, id bigint, text_sha256 string, h bigint, row {row_type}"
    arrow = to_arrow_schema(StructType.fromDDL(out))
    path = staging_path(spark, "exact-dedup")
    df.mapInArrow(_combine(arrow, text, table_bytes), out).write.partitionBy("kind").parquet(path)
    written = spark.read.schema(StructType.fromDDL(out)).parquet(path)
    members, reps = written.where("kind = 'member'"), written.where("kind = 'rep'").drop("kind")
    leaf, leaves = leaf_buckets(reps, reps.select("h", (F.octet_length(whole(F.col(f"row.`{text}`"))) + 64).alias("b")), bucket_bytes)
    if not with_rows:
        reps = reps.withColumn("row", F.struct(F.col(f"row.`{text}`").alias(text)))
    told = "cls bigint, keep_id bigint, group_size bigint, place bigint" + (f", row {row_type}" if with_rows else "")
    dealt = reps.select("h", "id", "cls", "n", "place", "row", leaf.cast("int").alias("leaf")).repartitionById(leaves, F.col("leaf"))
    verdicts = dealt.drop("leaf").mapInArrow(_compare(to_arrow_schema(StructType.fromDDL(told)), text, with_rows), told)
    if with_rows:
        verdicts = stage_table(verdicts, "exact-dedup-kept")
    v = verdicts.select("cls", "keep_id", "group_size", F.col("place").alias("v_place"))
    joined = members.select("cls", "place", "id", "text_sha256").join(v, "cls")
    real = lambda c: F.when(F.col(c) != LOWEST, F.col(c))
    return joined.select(real("id").alias("id"), real("keep_id").alias("keep_id"), "group_size",
                         F.coalesce(F.col("place") == F.col("v_place"), F.lit(False)).alias("kept"), "text_sha256"), verdicts


def kept_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """The rows that stay, with all their columns."""
    _, verdicts = exact_dedup(docs, key, text, with_rows=True, **sizes)
    return verdicts.where("place IS NOT NULL").select("row.*")


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    members, _ = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return members.withColumnRenamed("id", "doc_id")


ORACLE = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM t WINDOW g AS (PARTITION BY t)
"""
