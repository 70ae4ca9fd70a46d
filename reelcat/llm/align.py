"""Cross-tokenizer alignment: groups of overlapping tokens by pointer jumping, and their links weighed over the corpus.

Two tokenizers cut the same bytes. Tokens that overlap belong together, directly or through
others; the groups are the components of the overlaps, bounded where tokens of both end.

1. *Parts*: a text is cut before single spaces between other characters. No token goes over
   such a place (checked for the pieces when their file is read; the byte-level pattern
   never lets a space follow another character within a token), so distinct parts are encoded
   once a batch. Texts with other spacing are one part.
2. *Pointer jumping*: every token points to its farthest-right overlapping token (of equal
   ends, the first tokenizer's). Successor doubling, vectorised over all tokens of a batch,
   converges to each component's terminal token, which labels the group.
3. *Counts*: documents are staged with their distinct linked id pairs and how often each
   occurs. Spark counts documents by pair (with partial sums, so a pair that is in every
   document is no hot key) and takes each first id's highest count.
4. *Sums*: pairs meet their counts again. The most frequent pairs, up to ``COMMON`` by a
   counted bound, are broadcast; the others are joined by shuffle. A sum per document follows.

Links of a group are products of the numbers of equal ids, never listed one by one.

Nulls: a text that is null, empty, or that the tokens of either side don't give back byte
for byte has no tokens, so zeros and an empty ``groups_sha256``. Rows are told apart by a
number of their own: null, repeated or shared ids do no harm, and equal rows get equal
results (each counts as a document). An empty table gives an empty result; columns besides
``key`` and ``text`` are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import as_bytes, flat_ranges, list_array, small_batches, table
from reelcat.session import stage_table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: White space in any sense, as a regular expression.
SPACES = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
#: Fixed value of the byte-level format: what is split before merging.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text worked on at once, parts encoded in one call, pairs listed at once.
BATCH, CALL, PAIRS = 4 << 20, 1000, 1 << 20
#: Pairs (of a long, a count and a flag) that are broadcast at most.
COMMON = 1_000_000


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Side:
    """One tokenizer: ``encode`` gives the ids of each of some texts, ``contents`` the bytes of each id."""

    encode: object
    contents: list[bytes]

    def __post_init__(self):
        self.bytes = pa.array(self.contents, pa.binary())
        self.lengths = np.array([len(c) for c in self.contents], np.int64)

    def given_back(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        off, raw = as_bytes(self.bytes.take(pa.array(ids)))
        return raw[off[0] : off[-1]]

    def parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, flat ids, given back byte for byte) of the parts, each taken with a space before it."""
        none = np.zeros(0, np.int64)
        off, raw = as_bytes(pc.binary_join_element_wise("", parts, " "))
        raw, off = raw[off[0] : off[-1]], off - off[0]
        edged = np.asarray(pc.match_substring_regex(parts, f"^{SPACES}|{SPACES}$|^$"))  # their neighbours would matter
        together, alone = np.flatnonzero(~edged), np.flatnonzero(edged)
        calls = [together[k : k + CALL] for k in range(0, len(together), CALL)]
        order, flat, sizes, good = [], [], [], []
        for at, ids in zip(calls, self.encode([" ".join(parts.take(pa.array(at)).to_pylist()) for at in calls])):
            ids = np.array(ids, np.int64)
            lengths = off[at + 1] - off[at]
            if not np.array_equal(self.given_back(ids), raw[flat_ranges(off[at], lengths)]):
                alone = np.concatenate((alone, at))  # some part isn't given back: each on its own
                continue
            order.append(at)
            flat.append(ids)
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(lengths)) + 1, prepend=0))
            good.append(np.ones(len(at), bool))
        for i, ids in zip(alone.tolist(), self.encode(parts.take(pa.array(alone)).to_pylist())):
            order.append([i])
            flat.append(np.array(ids, np.int64))
            sizes.append([len(ids)])
            good.append([np.array_equal(self.given_back(flat[-1]), raw[off[i] : off[i + 1]])])
        back = np.argsort(np.concatenate([none, *order]))
        sizes = np.concatenate([none, *sizes])
        first, sizes = (np.cumsum(sizes) - sizes)[back], sizes[back]
        ids = np.concatenate([none, *flat])[flat_ranges(first, sizes)]
        return np.concatenate(([0], np.cumsum(sizes))), ids, np.concatenate([none.astype(bool), *good]).astype(bool)[back]


def byte_side(data: bytes) -> Side:
    """A byte-level BPE (JSON file); special tokens' strings are plain text, a space is put before each text.

    The file's merges are in the order of the ids they give (checked), so its entries are the
    ranks of a plain byte-pair encoder.
    """
    import tiktoken

    spec, to_byte = json.loads(data), byte_level()
    vocab = spec["model"]["vocab"]
    contents = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for t in spec["added_tokens"]:
        contents[t["id"]] = t["content"].encode()
    ranks = {bytes(map(to_byte.__getitem__, entry)): i for entry, i in vocab.items()}
    for entry, i in ranks.items():
        contents[i] = entry
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    made = [vocab[x + y] for x, y in pairs]
    if made != sorted(set(made)) or len(made) + 256 != len(vocab):
        raise ValueError("the merges are not in the order of their ids")
    bpe = tiktoken.Encoding("byte-level", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Side(lambda texts: [bpe.encode_ordinary(" " + t) for t in texts], contents)


def piece_side(data: bytes) -> Side:
    """A SentencePiece model with byte pieces, which puts the space itself."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(data)
    contents = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if SPACE in piece.lstrip(SPACE):
            raise ValueError(f"piece {i} goes over a space: {piece}")
        contents.append(bytes([int(piece[1:-1], 16)]) if sp.is_byte(i) else piece.replace(SPACE, " ").encode())
    return Side(lambda texts: sp.encode(texts, num_threads=1), contents)


def cut_parts(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, flat parts): texts cut at spaces if each stands alone between other characters, else whole; none of an empty text."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, f"^{SPACES}|{SPACES}$|{SPACES} | {SPACES}")
    split = pc.split_pattern(pc.if_else(odd, pa.scalar("", texts.type), texts), " ")
    sizes = np.diff(split.offsets.to_numpy()).astype(np.int64)
    flat = split.flatten()
    if pc.any(odd).as_py():
        first = np.cumsum(sizes) - sizes
        at = np.flatnonzero(np.asarray(odd))
        whole = pc.replace_with_mask(flat, pa.array(np.isin(np.arange(len(flat)), first[at])), texts.take(pa.array(at)))
        flat = whole
    empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
    keep = np.repeat(~empty, sizes)
    sizes[empty] = 0
    return np.concatenate(([0], np.cumsum(sizes))), flat.filter(pa.array(keep))


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number, from 0 on, of every token of both sides, given where tokens end in the same bytes."""
    n = len(a_ends)
    to_b = np.searchsorted(b_ends, a_ends)  # the token of the other side that holds the last byte overlaps farthest to the right
    to_a = np.searchsorted(a_ends, b_ends)
    p = np.concatenate((np.where(b_ends[to_b] > a_ends, n + to_b, np.arange(n)), to_a)) if n else np.zeros(0, np.int64)
    while True:
        q = p[p]
        if np.array_equal(p, q):
            break
        p = q
    number = np.cumsum(np.bincount(p, minlength=len(p)) > 0) - 1
    return number[p[:n]], number[p[n:]]


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, how often) of the distinct ids of each group."""
    key, times = np.unique(group << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, sum of their times)."""
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return key[at], np.add.reduceat(times[order], at) if len(at) else times


def _products(a, b, n_groups: int, width: int):
    """(first A row, pair, how often), some groups at a time: each group's distinct A ids with its distinct B ids."""
    (ga, ia, ta), (gb, ib, tb) = a, b
    b_first = np.searchsorted(gb, np.arange(n_groups + 1))
    sizes = np.diff(b_first)[ga]
    part = np.cumsum(sizes) // PAIRS
    for k in range(int(part[-1]) + 1 if len(part) else 0):
        rows = np.flatnonzero(part == k)
        left = np.repeat(rows, sizes[rows])
        right = flat_ranges(b_first[ga[rows]], sizes[rows])
        yield ga[left], ia[left] * width + ib[right], ta[left] * tb[right]


def _shown(a: Side, b: Side) -> pa.Array:
    """How tokens are written: A's ids before another of A, A's last, B's before another of B, B's last, one after the other."""
    return pa.array([f"{i}{mark}".encode() for side, marks in ((a, ",|"), (b, ",;")) for mark in marks for i in range(len(side.contents))], pa.binary())


@functools.lru_cache(1)
def _sides(first: bytes, second: bytes) -> tuple[Side, Side, pa.Array]:
    """Both tokenizers, made once a worker, and how their ids are written."""
    a, b = byte_side(first), piece_side(second)
    return a, b, _shown(a, b)


def _joined(shown: pa.Array, a: Side, b: Side, a_ids, b_ids, ga, gb, part_of_group: np.ndarray, n_parts: int) -> pa.Array:
    """Of each part, its groups as ``a1,a2|b1;...;``."""
    n = len(a_ids)
    order = np.argsort(np.concatenate((2 * ga, 2 * gb + 1)), kind="stable")  # A tokens come before B tokens of their group
    group = np.concatenate((ga, gb))[order]
    is_a = order < n
    last = np.ones(len(order), bool)  # of its side in its group
    last[:-1] = (group[1:] != group[:-1]) | (is_a[1:] != is_a[:-1])
    na, nb = len(a.contents), len(b.contents)
    at = np.concatenate((a_ids, b_ids))[order] + np.where(is_a, last * na, 2 * na + last * nb)
    off, raw = as_bytes(shown.take(pa.array(at)))
    cuts = off[np.searchsorted(part_of_group[group], np.arange(n_parts + 1))]
    return pa.Array.from_buffers(pa.large_binary(), n_parts, [None, pa.py_buffer(cuts), pa.py_buffer(raw)])


def _align(first: object, second: object):
    """Batches (key, text) to a row for each document, as ``aligned`` describes them (``r`` comes later)."""

    def run(batches):
        a, b, shown = _sides(first.value, second.value)
        width = len(b.contents)
        for batch in small_batches(batches, BATCH):
            off, parts = cut_parts(batch["text"])
            coded = parts.dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(off))
            (a_off, a_ids, a_good), (b_off, b_ids, b_good) = a.parts(coded.dictionary), b.parts(coded.dictionary)
            good = a_good & b_good
            bad_doc = np.zeros(batch.num_rows, bool)
            bad_doc[doc[~good[code]]] = True
            # groups of all good parts at once: both sides have the same bytes there
            u = len(coded.dictionary)
            a_part, b_part = np.repeat(np.arange(u), np.diff(a_off)), np.repeat(np.arange(u), np.diff(b_off))
            a_ids, a_part, b_ids, b_part = a_ids[good[a_part]], a_part[good[a_part]], b_ids[good[b_part]], b_part[good[b_part]]
            ga, gb = groups(np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids]))
            n_groups = int(ga[-1]) + 1 if len(ga) else 0
            part_of_group = np.zeros(n_groups, np.int64)
            part_of_group[ga] = a_part
            links = np.bincount(ga, minlength=n_groups) * np.bincount(gb, minlength=n_groups)
            per_part = [np.bincount(a_part, minlength=u), np.bincount(b_part, minlength=u), np.bincount(part_of_group, minlength=u),
                        np.bincount(part_of_group, links, minlength=u).astype(np.int64)]
            written = _joined(shown, a, b, a_ids, b_ids, ga, gb, part_of_group, u)
            # the distinct links of each part
            some = [(part_of_group[g], pair, t) for g, pair, t in _products(_counted(ga, a_ids), _counted(gb, b_ids), n_groups, width)]
            p_part, p_pair, p_times = (np.concatenate([x[k] for x in some]) if some else np.zeros(0, np.int64) for k in range(3))
            p_off = np.searchsorted(p_part, np.arange(u + 1))
            # documents: parts they hold, how often
            held = ~bad_doc[doc]
            doc, code = doc[held], code[held]
            sums = [np.bincount(doc, x[code], minlength=batch.num_rows).astype(np.int64) for x in per_part]
            key, often = np.unique(doc * u + code, return_counts=True)
            of_doc, of_part = key // max(u, 1), key % max(u, 1)
            sizes = np.diff(p_off)[of_part]
            pairs, times, ends = [], [], [np.zeros(1, np.int64)]
            step = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + 1, PAIRS)) if len(sizes) else np.zeros(0, np.int64)
            cuts = sorted({int(np.searchsorted(of_doc, of_doc[min(s, len(of_doc) - 1)])) for s in step} | {0, len(of_doc)})  # at documents
            counts = np.zeros(batch.num_rows, np.int64)
            for lo, hi in zip(cuts, cuts[1:]):
                at = flat_ranges(p_off[:-1][of_part[lo:hi]], sizes[lo:hi])
                d, pair, t = np.repeat(of_doc[lo:hi], sizes[lo:hi]), p_pair[at], p_times[at] * np.repeat(often[lo:hi], sizes[lo:hi])
                span = width * len(a.contents)
                key, t = _summed(d * span + pair, t)
                pairs.append(key % span)
                times.append(t)
                counts += np.bincount(key // span, minlength=batch.num_rows)
            ends = np.concatenate(([0], np.cumsum(counts)))
            pairs, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (pairs, times))
            spans = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            off, raw = as_bytes(written.take(pa.array(code)))
            digests = [hashlib.sha256(raw[off[s] : off[e] - 1]).hexdigest() if e > s else "" for s, e in zip(spans, spans[1:])]
            yield pa.RecordBatch.from_arrays([batch["key"], *(pa.array(x) for x in sums), pa.array(digests), list_array(pairs, ends, pa.int64()),
                                              list_array(times, ends, pa.int64())],
                                             names=["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return run


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", first: str = BYTE_BPE, second: str = PIECE_BPE) -> DataFrame:
    """(r, key, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) for each document, staged.

    ``r`` numbers the rows. ``pairs`` lists the distinct linked id pairs as first id times
    second vocabulary size plus second id, ``times`` how many links each stands for.
    """
    spark = docs.sparkSession
    files = []
    for path in (first, second):
        with open(path, "rb") as f:  # the driver reads the vocabularies; their size doesn't depend on the data
            files.append(spark.sparkContext.broadcast(f.read()))
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = "key bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    return stage_table(docs.mapInArrow(_align(*files), out).withColumn("r", F.monotonically_increasing_id()), "align-documents")


def pair_counts(staged: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many documents hold each pair linked, and whether no pair of its first id is in more."""
    n = stage_table(staged.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "align-counts")
    first = F.expr(f"pair div {width}")
    best = n.groupBy(first.alias("first")).agg(F.max("n").alias("most"))  # a row for each id of the first vocabulary at most
    return n.join(F.broadcast(best), first == best["first"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_sums(staged: DataFrame, counts: DataFrame, common: int = COMMON) -> DataFrame:
    """(r, n_best, count_sum) for each document with links."""
    counts = stage_table(counts, "align-weights")
    sizes = {int(x): int(c) for x, c in counts.groupBy(F.floor(F.log2("n")).alias("x")).count().collect()}  # one row a power of two
    least, seen = 0, 0
    for x in sorted(sizes, reverse=True):
        seen += sizes[x]
        if seen > common:
            least = 1 << (x + 1)
            break
    links = staged.select("r", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("r", F.col("l.pairs").alias("pair"), F.col("l.times").alias("t"))
    sums = [F.sum(F.expr("CASE WHEN best THEN t ELSE 0 END")).alias("n_best"), F.sum(F.expr("t * n")).alias("count_sum")]
    near = F.broadcast(counts.where(F.col("n") >= least))
    if not least:
        return links.join(near, "pair").groupBy("r").agg(*sums)
    rare = links.join(near.select("pair"), "pair", "left_anti")
    both = links.join(near, "pair").groupBy("r").agg(*sums).unionByName(rare.join(counts.where(F.col("n") < least), "pair").groupBy("r").agg(*sums))
    return both.groupBy("r").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, key: str = "doc_id", text: str = "text", first: str = BYTE_BPE, second: str = PIECE_BPE, common: int = COMMON) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each document."""
    staged = aligned(docs, key, text, first, second)
    with open(second, "rb") as f:
        width = len(piece_side(f.read()).contents)
    sums = link_sums(staged, pair_counts(staged, width), common)
    none = F.lit(0).cast("long")
    return staged.drop("pairs", "times").join(sums, "r", "left").select(
        "key", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")


def op13_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
