"""Suffix-array dedup: repeated byte strings by prefix doubling, reranked by Spark at chosen positions.

A byte goes if a string of ``threshold`` bytes that covers it also starts earlier (in a
document with a smaller id, or earlier in the same one). Doubling names the prefix of a
position by the pair of names half as long; positions whose name is unique are out:

1. *Within tasks*: names of 1, 2, 4, ... bytes up to half the threshold are 64-bit hashes of
   pairs, which need no exchange. Of each string of ``threshold`` bytes one position stands
   for it, the one with the smallest half-length name (leftmost if tied): equal strings
   choose the same one. So about one position in 26 takes part from here on.
2. *First rerank*: Spark counts the names at the chosen positions; unique ones are out. A name at more
   than one in HOT_NAMES of them is hot: there are fewer hot names than that, so they are broadcast.
3. *Second rerank*: the strings standing behind the positions left are shipped as one short
   slice per position, sorted by (name, document, position), named at full length, and every
   one but the first of a name is marked. Before that, slices that are equal within a batch
   are settled where they are: a passage in a third of all documents ships once a batch.
4. Marked strings are merged per document and cut out.

Whole documents that repeat an earlier one are settled by digest beforehand. Long documents
are worked on in overlapping pieces, so a task's memory is bounded.

Nulls: a null text is empty; a null id is smallest. Rows equal in id and text are one
document, judged alike; other rows that share an id are ordered by digest. Texts shorter
than the threshold stay. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import as_bytes, flat_ranges, only_ids, small_batches, table, whole
from reelcat.session import stage_table

U = np.uint64
LOWEST = -(1 << 63)
HIGH, LOW = U(0xFFFFFFFF00000000), U(0xFFFFFFFF)
BATCH = 2 << 20
#: A name at more than one in so many places is hot: there are fewer hot names than that.
HOT_NAMES = 4096
PIECE = 1 << 20
BYTE_NAMES = np.random.RandomState(7).randint(0, 1 << 62, 256).astype(U) * U(4) + U(1)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * U(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    return x


def names(raw: np.ndarray, width: int) -> np.ndarray:
    """The name of the ``width`` bytes at each position, by doubling; the last, odd step overlaps."""
    x, size = BYTE_NAMES[raw], 1
    while 2 * size <= width:
        x = _pair(x[:-size], x[size:])
        size *= 2
    if size < width:
        x = _pair(x[: len(raw) - width + 1], x[width - size :])
    return x


def chosen(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: int):
    """Chosen positions of the texts raw[start:end]: (text, name, position, first and last string start they stand for)."""
    empty = np.zeros(0, np.int64)
    counts = np.maximum(ends - starts - threshold + 1, 0)
    if not counts.sum():
        return empty, np.zeros(0, U), empty, empty, empty
    half = threshold // 2
    h = names(raw, half)
    m = (h & HIGH) | np.arange(len(h), dtype=U)
    size, width = 1, threshold - half + 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < width:
        m = np.minimum(m[: len(h) - width + 1], m[width - size :])
    at = flat_ranges(starts, counts)
    stands = (m[at] & LOW).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), counts)
    new = np.ones(len(at), bool)
    new[1:] = stands[1:] != stands[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    p = stands[first]
    return text[first], h[p], p, at[first], at[last]


def _pieces(batches, threshold: int):
    """(ids, raw, starts, ends, shift): batches of texts; a long text comes in overlapping pieces."""
    for batch in small_batches(batches, BATCH):
        off, raw = as_bytes(batch["t"])
        ids = np.asarray(batch["id"])
        if off[-1] - off[0] <= 2 * BATCH:
            yield ids, raw[off[0] : off[-1]], off[:-1] - off[0], off[1:] - off[0], np.zeros(len(ids), np.int64), batch
        else:
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                for c in range(a, max(a + 1, b - threshold + 1), PIECE):
                    part = raw[c : min(b, c + PIECE + threshold - 1)]
                    yield ids[i : i + 1], part, np.array([0]), np.array([len(part)]), np.array([c - a]), batch.slice(i, 1)


def _seeds(threshold: int):
    def run(batches):
        for ids, raw, starts, ends, shift, _ in _pieces(batches, threshold):
            text, h, p, lo, hi = chosen(raw, starts, ends, threshold)
            place = ((p - starts[text] + shift[text]) << 16) | ((p - lo) << 8) | (p - hi)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[text]), pa.array(place)], names=["h", "id", "place"])

    return run


def _slices(threshold: int):
    """Documents with their live places to slices (h, id, place, slice), and marks (id, start, stop) of repeats in the batch."""

    def run(batches):
        for batch in small_batches(batches, BATCH):
            off, raw = as_bytes(batch["t"])
            data = raw.data
            first: dict = {}
            marks = []
            for i, (doc, a) in enumerate(zip(batch["id"].to_pylist(), off[:-1].tolist())):
                for h, place in zip(*(batch[c][i].values.to_pylist() for c in ("hs", "places"))):
                    p = place >> 16
                    lo, hi = p - (place >> 8 & 255), p - (place & 255)
                    cut = bytes(data[a + lo : a + hi + threshold])
                    here = (doc, place, lo, hi)
                    there = first.setdefault((h, cut), here)
                    if there != here:
                        if here < there:
                            first[(h, cut)], here = here, there
                        marks.append((here[0], here[2], here[3] + threshold))
            kept = [(h, doc, place, cut) for (h, cut), (doc, place, _, _) in first.items()]
            for rows, names_ in ((kept, ("h", "id", "place", "slice")), (marks, ("id", "start", "stop"))):
                for k in range(0, len(rows), 1 << 14):
                    cols = dict(zip(names_, zip(*rows[k : k + (1 << 14)])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[c], t) if c in cols else pa.nulls(len(rows[k : k + (1 << 14)]), t)
                         for c, t in (("h", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("slice", pa.binary()),
                                      ("start", pa.int64()), ("stop", pa.int64()))],
                        names=["h", "id", "place", "slice", "start", "stop"])

    return run


def _mark(threshold: int):
    """Slices sorted by (h, id, place) to marks (id, start, stop); a class may go over many batches."""

    def run(batches):
        seen_h, seen, before = None, np.zeros(0, U), None
        for batch in small_batches(batches, BATCH):
            h, doc, place = (batch[c].to_numpy(zero_copy_only=False) for c in ("h", "id", "place"))
            off, raw = as_bytes(batch["slice"])
            raw, off = raw[off[0] : off[-1]], off - off[0]
            own = np.ones(len(h), bool)  # not a row that repeats the one before: the same place, met twice
            own[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
            own[0] = (int(h[0]), int(doc[0]), int(place[0])) != before
            before = (int(h[-1]), int(doc[-1]), int(place[-1]))
            counts = np.where(own, np.diff(off) - threshold + 1, 0)
            at = flat_ranges(off[:-1], counts)
            row = np.repeat(np.arange(len(h)), counts)
            name = names(raw, threshold)[at]
            keyed = _pair(name, h[row].view(U))
            order = np.argsort(keyed, kind="stable")
            again = np.zeros(len(at), bool)
            again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
            if seen_h == h[0]:
                mine = h[row] == seen_h
                again[mine] |= np.isin(name[mine], seen)
            tail = name[h[row] == h[-1]]
            seen = np.unique(np.concatenate((seen, tail))) if seen_h == h[-1] else np.unique(tail)
            seen_h = h[-1]
            # runs of marked strings within a row
            k = np.flatnonzero(again)
            if len(k):
                cut = np.flatnonzero((np.diff(k) > 1) | (row[k][1:] != row[k][:-1])) + 1
                a, b = k[np.concatenate(([0], cut))], k[np.concatenate((cut, [len(k)])) - 1]
                lo = (place >> 16) - (place >> 8 & 255)
                start = lo[row[a]] + at[a] - off[row[a]]
                stop = lo[row[b]] + at[b] - off[row[b]] + threshold
                yield pa.RecordBatch.from_arrays([pa.array(doc[row[a]]), pa.array(start), pa.array(stop)], names=["id", "start", "stop"])

    return run


def _cut(batches):
    """Documents with their marks (starts, stops) to what is left."""
    for batch in small_batches(batches, 4 * BATCH):
        off, raw = as_bytes(batch["t"])
        rows = []
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            spans: list[list[int]] = []
            for s, e in sorted(zip(batch["starts"][i].values.to_pylist(), batch["stops"][i].values.to_pylist())):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
            left, at = hashlib.sha256(), 0
            for s, e in [*spans, [b - a, b - a]]:
                left.update(raw[a + at : a + s])
                at = e
            rows.append((sum(e - s for s, e in spans), len(spans), left.hexdigest(), [x for s in spans for x in s]))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2]),
                                          pa.array(cols[3], pa.list_(pa.int64()))], names=["id", "n_removed", "n_spans", "kept_sha256", "cuts"])


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` (key, id, t) with ids that name one text each: new numbers in (id, digest) order where an id has several."""
    several = docs.groupBy("id").agg((F.min(F.xxhash64("t")) < F.max(F.xxhash64("t"))).alias("several")).where("several").limit(1)
    if not several.count():
        return docs
    digests = docs.select(F.col("id").alias("old"), F.sha2("t", 256).alias("digest")).distinct().orderBy("old", "digest")
    # numbers of globally sorted rows ascend; fixed once written
    numbers = stage_table(digests.withColumn("new", F.monotonically_increasing_id()), "suffix-ids")
    with_digest = docs.withColumn("digest", F.sha2("t", 256))
    return with_digest.join(numbers, (with_digest["id"] == numbers["old"]) & (with_digest["digest"] == numbers["digest"])).select(
        "key", F.col("new").alias("id"), "t")


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 100) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, cuts), one row for each input row.

    ``cuts`` lists the removed runs as start, stop, start, stop, ... in bytes; ``threshold`` may be 8 to 256.
    """
    if not 8 <= threshold <= 256:
        raise ValueError("threshold must be 8 to 256")
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("key"), whole(F.col(f"`{text}`")).alias("t"))
    docs = _told_apart(docs.select("key", F.coalesce("key", F.lit(LOWEST)).alias("id"), "t"))
    told = stage_table(docs.select("key", "id", F.octet_length("t").cast("long").alias("n_bytes"), F.sha2("t", 256).alias("digest")), "suffix-digests")
    firsts = told.where(F.col("n_bytes") >= threshold).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = stage_table(told.join(firsts, "digest").where("id > first").select("id"), "suffix-copies")
    owners = only_ids(docs.where(F.octet_length("t") >= threshold), copies, "id", "left_anti").select("id", "t")

    seeds = stage_table(owners.mapInArrow(_seeds(threshold), "h bigint, id bigint, place bigint"), "suffix-seeds")
    twice = stage_table(seeds.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "suffix-twice")
    # names at more than a share of all places are few, whatever the input, and aren't shuffled by
    hot = F.broadcast(stage_table(twice.where(F.col("k") > seeds.count() // HOT_NAMES).select("h"), "suffix-hot"))
    rest = seeds.join(hot, "h", "left_anti").join(twice.join(hot, "h", "left_anti"), "h", "left_semi")
    live = seeds.join(hot, "h", "left_semi").unionByName(rest).distinct()
    live = stage_table(live.groupBy("id").agg(F.collect_list("h").alias("hs"), F.collect_list("place").alias("places")), "suffix-live")
    held = only_ids(docs, live, "id").select("id", "t").join(live, "id")
    out = "h bigint, id bigint, place bigint, slice binary, start bigint, stop bigint"
    sliced = stage_table(held.select("id", "t", "hs", "places").mapInArrow(_slices(threshold), out), "suffix-slices")
    slices = sliced.where("h IS NOT NULL").select("h", "id", "place", "slice")
    marks = slices.repartition("h").sortWithinPartitions("h", "id", "place").mapInArrow(_mark(threshold), "id bigint, start bigint, stop bigint")
    marks = marks.unionByName(sliced.where("h IS NULL").select("id", "start", "stop")).distinct()
    marks = stage_table(marks.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")), "suffix-marks")
    marked = only_ids(docs, marks, "id").select("id", "t").join(marks, "id")
    cut = marked.mapInArrow(_cut, "id bigint, n_removed bigint, n_spans bigint, kept_sha256 string, cuts array<bigint>")
    cut = stage_table(cut.dropDuplicates(["id"]), "suffix-cut")

    copied = copies.select("id", F.lit(True).alias("copied")).distinct()
    end = told.join(cut, "id", "left").join(copied, "id", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return end.select(
        "key", "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), none).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(F.col("copied"), F.array(F.lit(0).cast("long"), "n_bytes")).otherwise(F.coalesce("cuts", F.array().cast("array<bigint>"))).alias("cuts"))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
