"""Line dedup: sharded cuckoo filters in front of exact reference counts, for documents that come and go.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
least ``min_chars`` code points that several documents hold lose all their lines, except
in the document with the smallest id that holds them. Keys travel as 128-bit digests.

An index holds three written tables: ``held`` (each document's keys by line), ``counts`` (of
each key, the exact number of documents that hold it and the smallest id) and ``filters`` (of
each shard of keys, a cuckoo filter of those with a count). Nothing is changed in place.

- *insert*: the new documents' keys are counted with partial sums (a line in a third of all
  documents is one row a task), and the distinct ones probe their shard's filter. Those it
  doesn't hold are new, so they are appended to ``counts`` unread; only the others are joined
  with it. New keys enter the filters; a filter that gets too full is made anew, twice as large,
  from the exact counts.
- *delete*: counts go down by the removed documents' keys. Keys at zero leave counts and
  filters; if the smallest holder went, the next one is found among the documents left. So an
  insertion that is deleted again leaves what was there before.
- *verdicts*: lines whose key has a smaller holder go. Keys of over a thousandth of all lines
  (so a thousand at most) are joined by broadcast, the others by shuffle.

A shard holds distinct keys only, dealt by hash, so no key makes one large.

Nulls: a null text is one empty line; a null id is largest, and all rows without id are one
document. Rows that share an id are one document, judged by their own lines; deleting an id
removes all of them, and an id is inserted once (or deleted before it comes again). An empty
table gives an empty result. Input columns travel in one struct, so their names don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.llm.common import WHITESPACE, ascii_lower, as_bytes, packed, sized, small_batches, table, whole
from reelcat.llm.cuckoo import CuckooFilter
from reelcat.session import stage_table

MIN_CHARS = 10
LARGEST = (1 << 63) - 1
#: Distinct keys that a shard is made for.
SHARD_KEYS = 1 << 18
#: A key of more than one line in so many is joined by broadcast.
HEAVY = 1000

HELD = "id bigint, digest string, n_lines int, keys array<binary>"
COUNTS = "shard int, key binary, n bigint, keeper bigint"
FILTERS = "shard int, capacity bigint, keys bigint, filter binary"


def line_keys(lines: Column, min_chars: int) -> Column:
    """The digests of lines' keys, null for short keys; each step binds its result once."""
    trimmed = F.transform(lines, lambda x: F.trim(x, F.lit(WHITESPACE)))
    lowered = F.transform(trimmed, lambda x: F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(ascii_lower(x)))  # quicker on ASCII
    return F.transform(lowered, lambda x: F.when(F.char_length(x) >= min_chars, F.unhex(F.substring(F.sha2(x, 256), 1, 32))))


def held_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, digest, n_lines, keys): of each document the digest of its text and its lines' keys in order, staged."""
    t = whole(F.col(f"`{text}`"))
    lines = F.split(t, "\n", -1)
    return stage_table(docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LARGEST)).alias("id"), F.sha2(t, 256).alias("digest"),
                                   F.size(lines).alias("n_lines"), line_keys(lines, min_chars).alias("keys")), "lines-held")


def _keys(table_: pa.Table) -> np.ndarray:
    """16-byte keys as rows of two unsigned longs."""
    off, raw = as_bytes(table_["key"].combine_chunks()) if len(table_) else (np.zeros(1, np.int64), np.zeros(0, np.uint8))
    return np.frombuffer(raw[off[0] : off[-1]].tobytes(), np.uint64).reshape(-1, 2)


def _filter(shard: pa.Table) -> CuckooFilter | None:
    return CuckooFilter.from_bytes(shard["filter"][0].as_py()) if len(shard) else None


def _probe(keys: pa.Table, shard: pa.Table) -> pa.Table:
    """The keys with whether the shard's filter holds them."""
    known = _filter(shard)
    maybe = np.zeros(len(keys), bool) if known is None or not len(keys) else known.contains(_keys(keys))
    return pa.table({**{c: keys[c] for c in ("shard", "key", "n", "keeper")}, "maybe": pa.array(maybe)})


def _change(keys: pa.Table, shard: pa.Table) -> pa.Table:
    """A shard's filter after its keys' insertions (``gone`` false) and deletions; made anew if ``all`` of its keys are given."""
    add = keys.filter(pc.invert(keys["gone"]))
    gone = keys.filter(keys["gone"])
    known = _filter(shard)
    if known is None or (len(keys) and keys["all"][0].as_py()):
        known, before = CuckooFilter(max(2 * len(add), 64)), 0
    else:
        before = shard["keys"][0].as_py()
        known.delete(_keys(gone))
    known.insert(_keys(add))
    number = keys["shard"][0].as_py() if len(keys) else shard["shard"][0].as_py()
    return pa.table({"shard": pa.array([number], pa.int32()), "capacity": pa.array([known.capacity], pa.int64()),
                     "keys": pa.array([before + len(add) - (len(gone) if before else 0)], pa.int64()), "filter": pa.array([known.to_bytes()], pa.binary())})


@dataclass(frozen=True)
class LineIndex:
    held: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def empty(cls, spark: SparkSession, keys: int = 0) -> LineIndex:
        """An index for about ``keys`` distinct keys (more only make its shards larger)."""
        shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // SHARD_KEYS))
        return cls(*(spark.createDataFrame([], x) for x in (HELD, COUNTS, FILTERS)), shards)

    def _counted(self, held: DataFrame) -> DataFrame:
        keys = held.select("id", F.explode(F.array_compact(F.array_distinct("keys"))).alias("key"))
        counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keeper"))
        return counted.select(F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard"), "key", "n", "keeper")

    def _changed(self, counts: DataFrame, added: DataFrame, gone: DataFrame) -> DataFrame:
        """The filters after keys (shard, key) came and went; ``counts`` are the counts then."""
        change = added.select("shard", "key", F.lit(False).alias("gone")).unionByName(gone.select("shard", "key", F.lit(True).alias("gone")))
        sizes = change.groupBy("shard").agg(F.sum(F.expr("CASE WHEN gone THEN 0 ELSE 1 END")).alias("more"))
        full = self.filters.join(sizes, "shard").where("keys + more > capacity").select("shard")
        full = F.broadcast(stage_table(full, "lines-full"))  # a row a shard at most
        rest = change.join(full, "shard", "left_anti").withColumn("all", F.lit(False))
        anew = counts.join(full, "shard", "left_semi").select("shard", "key", F.lit(False).alias("gone"), F.lit(True).alias("all"))
        pairs = rest.unionByName(anew).groupBy("shard").cogroup(self.filters.groupBy("shard"))
        return stage_table(pairs.applyInArrow(_change, FILTERS), "lines-filters")

    def insert(self, held: DataFrame) -> LineIndex:
        """The index with further documents (``held_lines``), whose ids it doesn't hold yet."""
        pairs = self._counted(held).groupBy("shard").cogroup(self.filters.drop("keys", "capacity").groupBy("shard"))
        probed = stage_table(pairs.applyInArrow(_probe, f"{COUNTS}, maybe boolean"), "lines-probed")
        new, maybe = probed.where("NOT maybe").drop("maybe"), probed.where("maybe").drop("maybe")
        old = self.counts.select("key", F.col("n").alias("old_n"), F.col("keeper").alias("old_keeper"))
        met = maybe.join(old, "key", "left")  # without a match the filter was wrong, and the key is new
        met = stage_table(met.select("shard", "key", (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"), F.least("keeper", "old_keeper").alias("keeper"),
                                     F.col("old_n").isNull().alias("fresh")), "lines-met")
        counts = self.counts.join(met.select("key"), "key", "left_anti").unionByName(met.drop("fresh")).unionByName(new)
        counts = stage_table(counts.select("shard", "key", "n", "keeper"), "lines-counts")
        filters = self._changed(counts, new.unionByName(met.where("fresh").drop("fresh")), new.limit(0))
        return replace(self, held=self.held.unionByName(held), counts=counts, filters=filters)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (their ids in the first column; null removes the rows without id)."""
        ids = stage_table(ids.select(F.coalesce(F.col(f"`{ids.columns[0]}`").cast("long"), F.lit(LARGEST)).alias("id")).distinct(), "lines-ids")
        some = sized(ids)
        left = stage_table(self.held.join(some, "id", "left_anti"), "lines-held")
        lost = stage_table(self._counted(self.held.join(some, "id", "left_semi")), "lines-lost")
        told = self.counts.join(lost.select("key", F.col("n").alias("less"), F.col("keeper").alias("lost")), "key", "left")
        told = stage_table(told.withColumn("left", F.col("n") - F.coalesce("less", F.lit(0))), "lines-told")
        orphans = told.where("left > 0 AND lost = keeper").select("shard", "key", F.col("left").alias("n"))
        holders = left.select("id", F.explode(F.array_compact(F.array_distinct("keys"))).alias("key")).join(orphans.select("key"), "key", "left_semi")
        orphans = orphans.join(holders.groupBy("key").agg(F.min("id").alias("keeper")), "key")
        kept = told.where("left > 0 AND (lost IS NULL OR lost > keeper)").select("shard", "key", F.col("left").alias("n"), "keeper")
        counts = stage_table(kept.unionByName(orphans.select("shard", "key", "n", "keeper")), "lines-counts")
        gone = told.where("left = 0")
        return replace(self, held=left, counts=counts, filters=self._changed(counts, gone.limit(0), gone))

    def dropped(self, held: DataFrame) -> DataFrame:
        """(id, digest, lines): of documents that lose lines, the numbers of these, from 0 on, staged."""
        shared = self.counts.where("n > 1").select("key", "n", "keeper")
        total = self.counts.agg(F.sum("n")).first()[0] or 0
        heavy = F.broadcast(shared.where(F.col("n") > total // HEAVY))
        lines = held.select("id", "digest", F.posexplode("keys").alias("line", "key")).where("key IS NOT NULL")
        few = lines.join(heavy.select("key"), "key", "left_anti").join(shared.where(F.col("n") <= total // HEAVY), "key")
        some = lines.join(heavy, "key").unionByName(few).where("id > keeper")
        return stage_table(some.groupBy("id", "digest").agg(F.collect_set("line").alias("lines")), "lines-dropped")


def _cut(batches):
    """Texts without the lines of these numbers."""
    for batch in small_batches(batches):
        parts = pc.split_pattern(batch["t"], "\n")
        off = parts.offsets.to_numpy().astype(np.int64)
        drop = batch["lines"]
        n = pc.list_value_length(drop).to_numpy(zero_copy_only=False)
        keep = np.ones(off[-1], bool)
        keep[np.repeat(off[:-1], n) + drop.flatten().to_numpy()] = False
        left = np.concatenate(([0], np.cumsum(keep)))[off]
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), parts.flatten().filter(pa.array(keep))), "\n")
        yield pa.RecordBatch.from_arrays([batch["row"], pa.array(n, pa.int64()), kept], names=["row", "n_dropped", "kept"])


def cleaned(docs: DataFrame, dropped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_dropped, kept) of the documents that lose lines: the input row and the text that is left."""
    t = whole(F.col(f"row.`{text}`"))
    df = packed(docs).select("row", t.alias("t"), F.coalesce(F.col(f"row.`{key}`").cast("long"), F.lit(LARGEST)).alias("id"), F.sha2(t, 256).alias("digest"))
    df = df.join(sized(dropped.select("id")), "id", "left_semi").join(dropped, ["id", "digest"])  # few texts are left to shuffle
    return df.select("row", "t", "lines").mapInArrow(_cut, f"row {df.schema['row'].dataType.simpleString()}, n_dropped bigint, kept string")


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, increments: int = 2):
    """(index, held, dropped) of a whole table, which enters the index in ``increments`` parts, dealt by id."""
    held = held_lines(docs, key, text, min_chars)
    index = LineIndex.empty(docs.sparkSession, held.agg(F.sum("n_lines")).first()[0] or 0)
    for k in range(increments):
        index = index.insert(held.where(F.pmod(F.xxhash64("id"), F.lit(increments)) == k))
    return index, held, index.dropped(held)


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, held, dropped = line_dedup(docs)
    cut = cleaned(docs, dropped).select(F.coalesce("row.doc_id", F.lit(LARGEST)).alias("id"), F.sha2(whole(F.col("row.text")), 256).alias("digest"),
                                        "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
    cut = stage_table(cut.dropDuplicates(["id", "digest"]), "lines-cut")
    return held.join(cut, ["id", "digest"], "left").select(
        F.when(F.col("id") != LARGEST, F.col("id")).alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("kept_sha256", "digest").alias("kept_sha256"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
keepers AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k),
judged AS (SELECT lines.*, coalesce(doc_id > keeper, false) AS goes FROM lines LEFT JOIN keepers ON lines.k = keepers.k AND length(lines.k) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
