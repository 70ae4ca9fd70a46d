"""N-gram Jaccard join by T-occurrence search (DivideSkip), and the components of its links.

A document is its set of distinct 4-word shingles. Two documents link when
100 * intersection >= 85 * union; the result names each document's component.

1. Documents with equal sets form a class; only classes are compared.
2. Shingles are ordered by a bounded count sketch (ordinary ones first, frequent ones
   last), then by hash. Of a set's first n - ceil(0.85 n) + c shingles, two sets that reach
   the threshold share c at least; c is 5 % of the set. Postings of shingles that a single
   class has are dropped, then classes left with fewer than c, then each class's c - 1 most
   frequent postings: of those left a linked pair still shares one.
3. The class of a list whose postings are most frequent in all is its *hub* (in a group of
   near copies, the text they come from), and a class joins the block of each hub it has.
   Two classes that share a list share its hub, so linked classes meet in a block. There are
   about as many (class, hub) rows as classes, where pairs would be quadratic.
4. Blocks are dealt to parts of about PART classes, the hub in each. A part is searched from the
   hub first, then from each class not connected with it yet, and hands out the links that
   connect what wasn't connected: fewer than it has classes. Two classes connected with the
   hub need no more; only a class that isn't is searched for in the other parts too, with
   up to BLOCK such classes and BLOCK others at a time. So a group of near copies costs rows in
   proportion to its classes. The links are united (large star, small star).

The search of a probe in a block's inverted lists sets its L longest lists aside, heap-merges
the short ones, and probes classes met T - L times in the long ones by binary search, until
the needed overlap T is reached or out of reach.

Nulls: a null text has no words; documents without words link with nothing (component:
themselves). A null id counts as absent when the smallest id is taken. Equal rows share a
class. An empty table gives an empty result. Shingles are compared by 64-bit hashes, sets
in step 1 by two 64-bit sums of hashes and their size.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelcat.llm.common import ascii_lower, list_array, only_ids, sized, small_batches, split_words, table, whole
from reelcat.llm.components import components
from reelcat.session import stage_table

SKETCH_BITS = 18
U = np.uint64
#: Classes of a part, in which a block is searched with its hub.
PART = 256
#: Classes without a link to their hub that are searched for at once, and of others they are searched in.
BLOCK = 2048
#: What a set is in the search: of a part, or in the second search connected with the hub, not connected, searched for.
MEMBER, DONE, OPEN, PROBE = range(4)
SHARED_PERCENT = 5
#: DivideSkip's weight of a binary search against a step of the merge.
MU = 0.001


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A finaliser of 64-bit hashes (xor-shift-multiply)."""
    x = x + U(salt)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the distinct shingles of each text, sorted by hash within a text.

    A text with fewer words has its whole sequence as its one shingle.
    """
    off, words = split_words(texts)
    coded = words.dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), U, len(coded.dictionary))
    w = known[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, U)
    n_words = np.diff(off)
    doc = np.repeat(np.arange(len(texts)), n_words)
    # the shingle that starts at each word, over as many words as are left in a short text
    left = np.repeat(off[1:], n_words) - np.arange(len(w))
    starts = (left >= width) | ((n_words[doc] < width) & (left == n_words[doc]))
    at = np.flatnonzero(starts)
    size = np.minimum(left[at], width)
    h = np.zeros(len(at), U)
    for k in range(width):
        more = size > k
        h[more] = _mixed(h[more], 0x9E3779B97F4A7C15) + w[at[more] + k]
    h = _mixed(h) ^ _mixed(size.astype(U), 7)
    d = doc[at]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[first], d[first]
    return np.concatenate(([0], np.cumsum(np.bincount(d, minlength=len(texts))))), h


def needed(n):
    """How many shingles of their prefixes two sets must share, the smaller having ``n``."""
    return 1 + n * SHARED_PERCENT // 100


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> U(64 - bits)).astype(np.int64)


def _counting(width: int, bits: int):
    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in small_batches(batches):
            _, h = shingle_sets(batch["t"], width)
            total += np.bincount(_bucket(h, bits), minlength=1 << bits)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])

    return run


def sketch(texts: DataFrame, width: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """A level for each of 2^bits buckets of shingles: 0 for ordinary counts, more for those that stand out.

    The driver receives 2^bits counters at most, whatever the input.
    """
    sums = texts.mapInArrow(_counting(width, bits), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = sums.toPandas()
    counts = np.zeros(1 << bits)
    counts[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    usual = counts.mean() + 4 * np.sqrt(counts.mean()) + 2
    return np.clip(np.floor(2 * np.log2(np.maximum(counts, 1) / usual)) + 1, 0, 120).astype(np.uint8)


def _prefixes(width: int, percent: int, bits: int, levels, names: list[str]):
    def run(batches):
        level = levels.value
        for batch in small_batches(batches):
            off, h = shingle_sets(batch["t"], width)
            n = np.diff(off)
            doc = np.repeat(np.arange(len(n)), n)
            sums = []
            for salt in (1, 2):
                run_up = np.concatenate(([U(0)], np.cumsum(_mixed(h, salt), dtype=U)))
                sums.append((run_up[off[1:]] - run_up[off[:-1]]).view(np.int64))
            h = h[np.lexsort((h, level[_bucket(h, bits)], doc))]
            first = np.minimum(n, n - (percent * n + 99) // 100 + needed(n))
            keep = (np.arange(len(h)) - off[doc]) < first[doc]
            prefix = list_array(h[keep].view(np.int64), np.concatenate(([0], np.cumsum(first))), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), pa.array(n), *map(pa.array, sums), prefix], names=[*names, "n", "k1", "k2", "prefix"])

    return run


def _full(width: int):
    def run(batches):
        for batch in small_batches(batches):
            off, h = shingle_sets(batch["t"], width)
            sums = []
            for salt in (1, 2):
                run_up = np.concatenate(([U(0)], np.cumsum(_mixed(h, salt), dtype=U)))
                sums.append((run_up[off[1:]] - run_up[off[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(off)), *map(pa.array, sums), list_array(h.view(np.int64), off, pa.int64())],
                                             names=["n", "k1", "k2", "tokens"])

    return run


class Lists:
    """The inverted lists of a block of sets (sorted arrays): for each shingle, the sets that have it, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, self.owners = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        self.shingles, self.starts = flat[first], np.append(first, len(flat))

    def divide_skip(self, probe: int, percent: int, wanted: np.ndarray) -> list[int]:
        """The ``wanted`` sets whose Jaccard similarity with ``probe`` reaches ``percent``."""
        n = int(self.sizes[probe])
        # overlap of at least percent / (100 + percent) * (n + m), with m at least percent of n
        need = -(-percent * (n + self.sizes) // (100 + percent))
        least = -(-percent * (n + -(-percent * n // 100)) // (100 + percent))
        k = np.searchsorted(self.shingles, self.sets[probe])
        lengths = self.starts[k + 1] - self.starts[k]
        k = k[np.argsort(lengths, kind="stable")]
        lists = [self.owners[a:b] for a, b in zip(self.starts[k].tolist(), self.starts[k + 1].tolist())]
        n_long = min(least - 1, int(least / (MU * np.log2(int(lengths.max()) + 1) + 1)))
        short, long = lists[: n - n_long], lists[n - n_long :]
        met: list[int] = []
        times: list[int] = []
        for member in heapq.merge(*[x.tolist() for x in short if len(x) > 1]):
            if met and met[-1] == member:
                times[-1] += 1
            else:
                met.append(member)
                times.append(1)
        c, t = np.array(met, np.int64), np.array(times, np.int64)
        fits = wanted[c] & (100 * np.minimum(n, self.sizes[c]) >= percent * np.maximum(n, self.sizes[c])) if len(c) else np.zeros(0, bool)
        c, t = c[fits], t[fits]
        left = n_long
        for x in reversed(long):  # from the shorter of the long ones
            alive = t + left >= need[c]
            c, t = c[alive], t[alive]
            if not len(c):
                break
            at = np.minimum(np.searchsorted(x, c), len(x) - 1)
            t = t + (x[at] == c)
            left -= 1
        return c[t >= need[c]].tolist() if len(c) else []


def connected(sets: list[np.ndarray], probes: list[int], percent: int, together: list[int]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links of the ``probes`` that connect what all their links connect, and each set's root in the end.

    ``together`` lists sets that are connected from the start; what is connected with them isn't searched for any more.
    """
    lists, root = Lists(sets), np.arange(len(sets))
    root[together] = together[:1] or 0
    links = []
    for probe in probes:
        if together and probe != together[0] and root[probe] == root[together[0]]:
            continue  # a link to a set elsewhere is found from there
        for other in lists.divide_skip(probe, percent, root != root[probe]):
            if root[other] != root[probe]:
                links.append((probe, other))
                root[root == root[other]] = root[probe]
    return links, root


def _search(percent: int):
    """Rows sorted by (hub, p1, p2, c), a probe before its like: a part's or tile's sets. Yields links (null, u, v) and open classes (hub, c, null)."""

    def run(batches):
        key, ids, states, block = None, [], [], []
        out = []

        def close():
            if len(block) > 1:
                if states[0] == MEMBER:
                    hub = ids.index(key[0])
                    links, root = connected(block, [hub, *(i for i in range(len(ids)) if i != hub)], percent, [hub])
                    if key[2]:  # the block has other parts
                        out.extend((key[0], ids[i], None) for i in np.flatnonzero(root != root[hub]).tolist())
                else:
                    at = [[i for i, s in enumerate(states) if s == x] for x in (PROBE, DONE)]
                    links, _ = connected(block, at[0], percent, at[1])
                out.extend((None, ids[a], ids[b]) for a, b in links)

        for batch in small_batches(batches):
            off = batch["tokens"].offsets.to_numpy()
            flat = batch["tokens"].values.to_numpy().view(U)
            for i, (hub, p1, p2, c, state) in enumerate(zip(*(batch[x].to_pylist() for x in ("hub", "p1", "p2", "c", "state")))):
                if (hub, p1, p2) != key:
                    close()
                    key, ids, states, block = (hub, p1, p2), [], [], []
                if not ids or ids[-1] != c:
                    ids.append(c)
                    states.append(state)
                    block.append(flat[off[i] : off[i + 1]].copy())
        close()
        for at in range(0, max(1, len(out)), 1 << 16):
            cols = list(zip(*out[at : at + (1 << 16)])) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["hub", "u", "v"])

    return run


def _searched(tiles: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """(hub, u, v) of ``tiles`` (hub, p1, p2, c, state), staged; ``sets`` is (c, tokens)."""
    rows = sets.join(sized(stage_table(tiles, f"ngram-{name}-tiles")), "c")
    rows = rows.repartition("hub", "p1", "p2").sortWithinPartitions("hub", "p1", "p2", "c", F.desc("state"))
    found = rows.select("hub", "p1", "p2", "c", "state", "tokens").mapInArrow(_search(percent), "hub bigint, u bigint, v bigint")
    return stage_table(found, f"ngram-{name}")


def _dealt(parts) -> F.Column:
    return F.pmod(F.xxhash64("c"), parts).cast("int")


def search(members: DataFrame, sets: DataFrame, percent: int, part: int | None = None, block: int | None = None) -> DataFrame:
    """Links (u, v) that connect the linked classes of each block of the staged ``members`` (hub, c); ``sets`` is (c, tokens)."""
    part, block = part or PART, block or BLOCK
    sizes = stage_table(members.groupBy("hub").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "ngram-blocks")
    parts = F.ceil(F.col("k") / part)
    own = F.when(F.col("c") == F.col("hub"), F.sequence(F.lit(0), (parts - 1).cast("int"))).otherwise(F.array(_dealt(parts)))
    first = members.join(sized(sizes), "hub").select("hub", F.explode(own).alias("p1"), (parts > 1).cast("int").alias("p2"), "c", F.lit(MEMBER).alias("state"))
    found = _searched(first, sets, percent, "parts")
    links, left = found.where("hub IS NULL").select("u", "v"), found.where("hub IS NOT NULL").select("hub", F.col("u").alias("c"))
    if left.isEmpty():
        return links
    # open classes against the whole block: up to `block` of them at a time, in parts of about as many classes
    m = left.groupBy("hub").agg(F.count(F.lit(1)).alias("m"))
    cut = sizes.join(m, "hub").select("hub", F.ceil(F.col("m") / block).alias("groups"), F.ceil(F.col("k") / F.greatest(F.lit(part), F.least("m", F.lit(block)))).alias("parts"))
    cut = sized(stage_table(cut, "ngram-open"))
    every = [F.sequence(F.lit(0), (F.col(x) - 1).cast("int")) for x in ("parts", "groups")]
    state = F.when(F.col("open"), OPEN).otherwise(DONE)
    others = members.join(cut, "hub").join(left.withColumn("open", F.lit(True)), ["hub", "c"], "left").select(
        "hub", _dealt(F.col("parts")).alias("p1"), F.explode(every[1]).alias("p2"), "c", state.alias("state"))
    probes = left.join(cut, "hub").select("hub", F.explode(every[0]).alias("p1"), _dealt(F.col("groups")).alias("p2"), "c", F.lit(PROBE).alias("state"))
    return links.unionByName(_searched(others.unionByName(probes), sets, percent, "open-links").select("u", "v"))


def _shortened(postings: DataFrame, percent: int) -> DataFrame:
    """(c, token, weight): the postings that classes keep, and how frequent all of a class's postings are."""
    met = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    live = stage_table(postings.join(met, "token"), "ngram-postings")
    own = Window.partitionBy("c")
    # the smaller of a linked pair has at least ``percent`` of this one's shingles
    least = 1 + F.floor(F.floor((percent * F.col("n") + 99) / 100) * SHARED_PERCENT / 100).cast("int")
    live = live.withColumns({"least": least, "have": F.count(F.lit(1)).over(own), "weight": F.sum("df").over(own)})
    live = live.where("have >= least").withColumn("place", F.row_number().over(own.orderBy("df", "token")))
    return stage_table(live.where("place <= have - (least - 1)").select("c", "token", "weight"), "ngram-shortened")


def ngram_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85, number: str | None = None) -> DataFrame:
    """(id, r, n_shingles, component_id, kept), one row for each input row.

    ``r`` is the column ``number``, which differs from row to row, or else a number of the
    row. One row of each component is kept, of those with the smallest id the one with the
    smallest ``r``, and every row without words.
    """
    spark = docs.sparkSession
    numbered = [] if number is None else [F.col(f"`{number}`").cast("long").alias("r")]
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), *numbered, ascii_lower(whole(F.col(f"`{text}`"))).alias("t"))
    levels = spark.sparkContext.broadcast(sketch(texts.select("t"), width))
    names = [x for x in texts.columns if x != "t"]
    members = texts.mapInArrow(_prefixes(width, percent, SKETCH_BITS, levels, names),
                               ", ".join(f"{x} bigint" for x in [*names, "n", "k1", "k2"]) + ", prefix array<bigint>")
    members = members if numbered else members.withColumn("r", F.monotonically_increasing_id())
    members = stage_table(members, "ngram-members")  # r is fixed once written
    narrow = members.where("n > 0").select("id", "n", "k1", "k2", "r")
    classes = narrow.groupBy("n", "k1", "k2").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "r")).alias("rep"))
    classes = stage_table(classes.select("n", "k1", "k2", F.col("rep.id").alias("id"), F.col("rep.r").alias("c")), "ngram-classes")
    copies = narrow.join(classes.select("n", "k1", "k2", "c"), ["n", "k1", "k2"]).where("r <> c").select("r")
    firsts = only_ids(members.where("n > 0").select("r", "n", "prefix"), stage_table(copies, "ngram-copies"), "r", "left_anti")
    live = _shortened(firsts.select(F.col("r").alias("c"), "n", F.explode("prefix").alias("token")), percent)

    lists = live.groupBy("token").agg(F.max(F.struct("weight", "c")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1")
    blocks = live.select("c", "token").join(lists.select("token", F.col("top.c").alias("hub")), "token").select("hub", "c").distinct()
    blocks = stage_table(blocks, "ngram-members-of-blocks")

    # whole sets of the classes that meet another one
    active = stage_table(classes.join(blocks.select("c").distinct(), "c", "left_semi"), "ngram-active")
    again = only_ids(texts, active, "id").select("t")
    sets = again.mapInArrow(_full(width), "n bigint, k1 bigint, k2 bigint, tokens array<bigint>")
    sets = stage_table(sets.join(sized(active.select("c", "n", "k1", "k2")), ["n", "k1", "k2"]).select("c", "tokens"), "ngram-sets")
    roots = components(stage_table(search(blocks, sets, percent), "ngram-links"))

    labels = roots.select(F.col("u").alias("c"), F.col("root").alias("label"))
    own = classes.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    first = own.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "c")).alias("first"))
    named = own.join(first, "label").select("n", "k1", "k2", "first")
    out = members.drop("prefix").join(named, ["n", "k1", "k2"], "left")
    return out.select("id", "r", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
                      ((F.col("n") == 0) | F.col("r").eqNullSafe(F.col("first.c"))).alias("kept"))


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id), one row for each input row."""
    return ngram_rows(docs, key, text, width, percent).select("id", "n_shingles", "component_id")


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
