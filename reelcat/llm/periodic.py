"""Periodic run detection: Lyndon words grouped as in the first phase of Baier's suffix sorter, extended into runs.

A run is a stretch of consecutive words with smallest period q, at least ``min_length``
and ``min_exponent`` times q long, that no neighbouring word extends keeping the period.

1. *Stretches*: within a run every three consecutive words come back at least
   ``min_exponent - 1`` times, so a text is cut where three words are rarer than that in it
   (by hashed counts, which never count too few). Runs lie within the stretches between.
2. *Grouping*: blocks of words start as single words, grouped by word. From the highest
   group down, each chain of k blocks of the group joins the block before it, whose group
   splits by k. A block's length when its group is taken is that of the longest Lyndon word
   at its head, and equal words have equal groups: the Lyndon array comes from the grouping
   itself, with no suffix array. This is done under the words' order and its reverse.
3. *Extension*: heads of one group, each one length after the other, are Lyndon roots of one
   repetition; its first and last are extended by common extensions to the left and right.
   A run of the exponent wanted has at least ``min_exponent - 1`` roots under an order.

Work per document is linear in its words, but for the extensions, which are shorter than
the roots they extend. Documents are worked on where they are: no exchange.

Nulls: a null text has no words and no runs, and collapses to the empty text. A text shorter
than a run has none. Null, repeated or shared ids do no harm: each row is judged by itself.
An empty table gives an empty result; columns besides ``key`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import small_batches, split_words, table, whole, words_of

U = np.uint64
GRAM = 3
#: Counters of three-word hashes for a batch: collisions only let a stretch be longer.
COUNTERS = 1 << 22
BATCH = 8 << 20


def lyndon_groups(words: list[int]) -> tuple[list[int], list[int]]:
    """(length, group) of the longest Lyndon word at each position; equal words have equal groups.

    ``words`` are numbers, ordered as the alphabet is. The end of the text is smaller than any word.
    """
    n = len(words)
    rank = {w: k for k, w in enumerate(sorted(set(words)))}
    group = [rank[w] for w in words]
    members: list[list[int]] = [[] for _ in rank]
    for i, g in enumerate(group):
        members[g].append(i)
    lower, higher = list(range(-1, len(rank) - 1)), [*range(1, len(rank)), -1]
    before, end = list(range(-1, n - 1)), list(range(1, n + 1))  # of a block, by its head: the head before it, and its end
    length = [0] * n
    at = len(rank) - 1
    while at >= 0:
        joined = []  # (group, chain length, head) of blocks that take in a chain of this group
        for i in members[at]:
            if group[i] != at:
                continue  # it has taken in a higher block and moved on
            length[i] = end[i] - i
            head = before[i]
            if head >= 0 and group[head] == at:
                continue  # within a chain
            k, stop = 1, end[i]
            while stop < n and group[stop] == at:
                k += 1
                stop = end[stop]
            if head >= 0:
                joined.append((group[head], k, head))
            elif stop < n:
                before[stop] = -1
        # blocks are only joined now: chains are read off the blocks as they were
        joined.sort()
        last = None
        for g, k, head in joined:
            stop = end[head]
            for _ in range(k):
                stop = end[stop]
            end[head] = stop
            if stop < n:
                before[stop] = head
            if last is None or last[0] != g or last[1] != k:
                below = g if last is None or last[0] != g else new
                new = len(members)  # right above the group that splits, longer chains above shorter ones
                members.append([])
                above = higher[below]
                lower.append(below)
                higher.append(above)
                higher[below] = new
                if above >= 0:
                    lower[above] = new
                last = (g, k)
            members[new].append(head)
            group[head] = new
        at = lower[at]
    return length, group


def common_extension(words: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words agree from i and j on, i < j, going right (step 1) or left (step -1)."""
    room = len(words) - j if step == 1 else i + 1
    done, size = 0, 16
    while done < room:
        size = min(size, room - done)
        if step == 1:
            differ = words[i + done : i + done + size] != words[j + done : j + done + size]
        else:
            a, b = i - done, j - done
            differ = words[a - size + 1 : a + 1][::-1] != words[b - size + 1 : b + 1][::-1]
        if differ.any():
            return done + int(differ.argmax())
        done += size
        size *= 2
    return done


def runs_of(words: np.ndarray, min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """The runs (start, length, period) of a stretch of numbered words."""
    n, found = len(words), set()
    values = words.tolist()
    for order in (values, [-w for w in values]):
        length, group = (np.array(x) for x in lyndon_groups(order))
        here = np.arange(n)
        after, ahead = here + length, here - length
        again = after < n
        again[again] = group[after[again]] == group[again]
        begun = ahead >= 0
        begun[begun] = group[ahead[begun]] == group[begun]
        first = again & ~begun
        if min_exponent > 3:
            at = np.flatnonzero(first)
            first[at] = again[after[at]]  # three roots at least
        for i in np.flatnonzero(first).tolist():
            q = int(length[i])
            roots = 2
            while again[i + (roots - 1) * q]:
                roots += 1
            if roots < min_exponent - 1:
                continue
            start = i - common_extension(words, i - 1, i - 1 + q, -1) if i else 0
            stop = i + roots * q
            stop += common_extension(words, stop - q, stop, 1)
            if stop - start >= max(min_length, min_exponent * q):
                found.add((start, stop - start, q))
    return found


def stretches(words: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the stretches of the documents' numbered words that may hold runs."""
    n = len(words) - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none
    h = doc.astype(U) * U(0x9E3779B97F4A7C15)
    h = h[:n]
    for k in range(GRAM):
        h = (h ^ words[k : n + k].astype(U)) * U(0xBF58476D1CE4E5B9)
        h ^= h >> U(29)
    h = (h >> U(20)).astype(np.int64) & (COUNTERS - 1)
    within = doc[:n] == doc[GRAM - 1 :]
    least = min(min_exponent - 1, max(min_length, min_exponent) - GRAM + 1)
    often = within & (np.bincount(h[within], minlength=COUNTERS)[h] >= least)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
    starts, sizes = edges[::2], edges[1::2] - edges[::2] + GRAM - 1  # of grams of one document, as none goes over its end
    cut = np.flatnonzero(doc[starts] != doc[starts + sizes - 1])
    keep = sizes >= min_length
    return (starts[keep], sizes[keep]) if not len(cut) else _at_documents(starts, sizes, doc, min_length)


def _at_documents(starts, sizes, doc, min_length):
    """Stretches cut where a document ends."""
    out = []
    for s, n in zip(starts.tolist(), sizes.tolist()):
        edges = [0, *(np.flatnonzero(np.diff(doc[s : s + n])) + 1).tolist(), n]
        out += [(s + a, b - a) for a, b in zip(edges, edges[1:]) if b - a >= min_length]
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _detect(min_length: int, min_exponent: int):
    def run(batches):
        for batch in small_batches(batches, BATCH):
            off, flat = split_words(batch["text"])
            words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(off))
            found: list[tuple[int, int, int, int]] = []
            for s, n in zip(*(x.tolist() for x in stretches(words, doc, min_length, min_exponent))):
                d = int(doc[s])
                found += [(d, s - int(off[d]) + a, size, q) for a, size, q in runs_of(words[s : s + n], min_length, min_exponent)]
            found.sort(key=lambda x: (x[0], x[1], x[3]))
            d, start, size, q = np.array(found, np.int64).reshape(-1, 4).T
            drop = np.zeros(len(words), bool)
            for a, b in zip((off[d] + start + q).tolist(), (off[d] + start + size).tolist()):
                drop[a:b] = True
            kept = np.concatenate(([0], np.cumsum(~drop)))[off]
            lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(~drop)))
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(batch.num_rows + 1)), pa.int32()),
                                            pa.StructArray.from_arrays([pa.array(x) for x in (start, size, q)], fields=list(RUN)))
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.diff(off)), runs, pc.binary_join(lists, " ")],
                                             names=["key", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(key, n_words, runs, collapsed) for each document.

    ``runs`` lists (start, length, period) in words by start, then period; ``collapsed`` is the
    text's words, joined by one space, without those that a run holds after its first period.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    out = f"key {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.mapInArrow(_detect(min_length, min_exponent), out)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by their id's checksum, repeat themselves from some word on."""
    words = words_of(whole(F.col("text")))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n = F.size(words)
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    times = 3 + g % 8
    p = (1 + F.floor((n - a) / times)).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), (times + 1).cast("int")))  # times + 1 of them are enough
    repeated = F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n)
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    out = found.withColumn("best", best).withColumn("start", -F.col("best.col2")).withColumn("length", F.col("best.length")).withColumn("period", -F.col("best.col3"))
    return out.select(F.col("key").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
                      F.expr("1000 * length div period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))
