"""Exact, near and substring deduplication against brute force, with the hard cases of their docstrings."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelcat.llm import components, exact_dedup, ngram_join, suffix_dedup

DOCS = "doc_id bigint, text string"


def lower(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# ---------------------------------------------------------------- exact


@pytest.mark.parametrize("bucket, table", [(1 << 26, 1 << 26), (1 << 16, 1 << 9), (1 << 14, 1)])
def test_exact_groups_agree_with_a_dictionary(spark, bucket, table):
    rng = random.Random(4)
    base = [None, "", "A", "a", "É", "é", "x" * 100_000] + [f"t{i}" * (i % 40) for i in range(150)]
    rows = [(i, rng.choice(base[:12]) if i % 3 == 0 else rng.choice(base)) for i in range(900)] + [(7, "A"), (7, "A"), (None, "t1"), (None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(6).withColumn("h", F.lit("clash")).withColumn("cls", F.lit(1)).withColumn("row", F.lit(2))
    members, verdicts = exact_dedup.exact_dedup(df, with_rows=True, bucket_bytes=bucket, table_bytes=table)
    got = members.collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(by_sha)  # one row of each group, also of repeated rows
    out = verdicts.where("place IS NOT NULL").select("row.*").collect()
    assert sorted(lower(r.text) for r in out) == sorted(groups) and out[0].h == "clash"
    assert all(r.doc_id == max((i for i in groups[lower(r.text)] if i is not None), default=None) for r in out)


def test_open_table_compares_whole_contents():
    t = exact_dedup.OpenTable(8)
    entries = [t.entry(5, str(i).encode()) for i in range(50)]  # one hash for all
    assert entries == list(range(50)) and [t.entry(5, str(i).encode()) for i in range(50)] == entries


def test_exact_dedup_of_an_empty_table(spark):
    members, _ = exact_dedup.exact_dedup(spark.createDataFrame([], DOCS))
    assert members.count() == 0 and exact_dedup.kept_documents(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- near


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def near_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                root[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        lowest[r] = d if lowest.get(r) is None else lowest[r] if d is None else min(lowest[r], d)
    return sorted((d if d is not None else -1, len(s), (lowest[find(i)] if s else d) if d is not None else -1) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", "one", "ONE", "one two three", "a b c d", "A b  c\td", "x " * 500, "x " * 400]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(3, 14)):  # a chain of edits: near neighbours link, far ones may not
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    texts += [" ".join(rng.choice(["the", "of", "and", "to"]) for _ in range(rng.randint(8, 60))) for _ in range(60)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [shared + " " + " ".join(rng.choice(vocabulary) + str(i) for _ in range(25)) for i in range(40)]
    texts += [texts[10]] * 30
    return list(enumerate(texts)) + [(5, "a b c d")]


@pytest.mark.parametrize("block", [4096, 6])
def test_near_components_agree_with_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PART", block)
    rows = near_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("c", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("n", F.lit(1))
    got = sorted(tuple(r) for r in ngram_join.ngram_join(df).select("id", "n_shingles", "component_id").collect())
    assert got == near_components(rows)


def test_blocks_in_parts_connect_what_all_pairs_connect(spark):
    """A hub with near sets, sets near those but not the hub, sets near one another only, and strangers."""
    rng = np.random.RandomState(4)

    def near(x, n):
        out = x.copy()
        out[rng.choice(len(x), n, replace=False)] = rng.randint(1 << 40, 1 << 50, n)
        return np.unique(out)

    hub = np.unique(rng.randint(0, 1 << 30, 100))
    sets = {0: hub}
    for i in range(1, 150):
        kind = i % 5
        sets[i] = near(hub if kind < 2 else sets[i - 1] if kind == 2 else sets[max(3, i - 5)] if kind == 3 and i > 5 else np.unique(rng.randint(0, 1 << 50, 100)), rng.randint(1, 7))
    linked = [(a, b) for a in sets for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]

    def groups(links):
        root = {i: i for i in sets}
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    members = spark.createDataFrame([(0, i) for i in sets], "hub bigint, c bigint")
    tokens = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in sets.items()], "c bigint, tokens array<bigint>")
    for part, block in ((16, 8), (16, 500), (40, 3), (500, 500)):
        links = [tuple(r) for r in ngram_join.search(members, tokens, 85, part, block).collect()]
        assert {(max(x), min(x)) for x in links} <= set(linked) and groups(links) == groups(linked)


def test_a_hub_of_near_copies_costs_rows_in_proportion(spark, monkeypatch):
    k, staged = 3000, {}
    members = spark.range(k).select(F.lit(0).cast("long").alias("hub"), F.col("id").alias("c"))
    same = F.sequence(F.lit(1000).cast("long"), F.lit(1039).cast("long"))
    tokens = members.select("c", F.when(F.col("c") == 0, same).otherwise(F.concat(same, F.array(F.col("c") + 10_000))).alias("tokens"))
    plain = ngram_join.stage_table
    monkeypatch.setattr(ngram_join, "stage_table", lambda df, name: staged.setdefault(name, plain(df, name)))
    assert ngram_join.search(members, tokens, 85, 64, 64).count() == k - 1
    assert staged["ngram-parts-tiles"].count() <= k + k // 64 + 1 and "ngram-open-links-tiles" not in staged


def test_near_duplicates_of_an_empty_table(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], DOCS)).count() == 0


def test_divide_skip_agrees_with_set_operations():
    rng = np.random.RandomState(1)
    for _ in range(60):
        base = np.unique(rng.randint(0, 400, 120)).astype(np.uint64)
        sets = [base] + [np.unique(np.concatenate((base[rng.rand(len(base)) < rng.choice([0.6, 0.9, 1])], rng.randint(0, 400, rng.randint(0, 20)).astype(np.uint64))))
                         for _ in range(40)]
        lists = ngram_join.Lists(sets)
        for p in (0, 7):
            want = [i for i, s in enumerate(sets) if i != p and 100 * len(np.intersect1d(s, sets[p])) >= 85 * len(np.union1d(s, sets[p]))]
            wanted = np.arange(len(sets)) != p
            assert lists.divide_skip(p, 85, wanted) == want


def test_components_of_random_edges(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(3, 3)]
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    assert got == {v: r for v, r in root.items() if r != v}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# ---------------------------------------------------------------- substrings


def cut_out(rows, width):
    docs = sorted({(i if i is not None else -(1 << 63), hashlib.sha256((t or "").encode()).hexdigest(), (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for i, _, b in docs:
        hit = bytearray(len(b))
        for k in range(len(b) - width + 1):
            s = b[k : k + width]
            if s in seen:
                hit[k : k + width] = b"\x01" * width
            seen.add(s)
        runs = re.findall(b"\x01+", bytes(hit))
        left = bytes(c for c, x in zip(b, hit) if not x)
        out[i, b] = (len(b), sum(map(len, runs)), len(runs), hashlib.sha256(left).hexdigest())
    return sorted(((i if i is not None else -1), *out[i if i is not None else -(1 << 63), (t or "").encode()]) for i, t in rows)


@pytest.mark.parametrize("width, hot", [(8, 1), (25, 40), (100, 4096), (100, 1)])
def test_removed_bytes_agree_with_a_set_of_strings(spark, monkeypatch, width, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_NAMES", hot)  # no name is hot, some are, all are
    monkeypatch.setattr(suffix_dedup, "BATCH", 1 << 11)  # many batches, and long texts in pieces
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 10)
    rng = random.Random(width)
    passage = ["".join(rng.choice("abé日 ") for _ in range(rng.randint(width, 3 * width))) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "a" * (5 * width)), (3, "ab" * (3 * width)), (4, "short")]
    for i in range(120):
        text = "".join(rng.choice(passage) if rng.random() < 0.3 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 2 * width))) for _ in range(rng.randint(1, 4)))
        rows.append((5 + i, text))
    rows += [(200 + i, rows[20][1]) for i in range(30)]  # whole copies
    rows += [(300 + i, rows[21][1][:-1] + "z") for i in range(30)]
    rows += [(400, "".join(rng.choice("abc") for _ in range(9000))), (401, rows[25][1]), (401, rows[25][1]), (None, rows[26][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).repartition(4).withColumn("h", F.lit(0)).withColumn("key", F.lit("clash"))
    got = suffix_dedup.suffix_dedup(df, threshold=width).select(F.coalesce("key", F.lit(-1)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == cut_out(rows, width)


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b = "q" * 50 + "".join(map(chr, range(97, 123))) * 5, "".join(map(chr, range(97, 123))) * 5
    rows = [(1, a), (1, b), (2, b + "!"), (2, b + "!")]
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, DOCS)).select("key", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == cut_out(rows, 100)


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_large_buckets_are_split_until_they_fit_or_hold_one_hash(spark):
    # all hashes agree in their low bits, and one of them is hot
    rows = [(i << 12 | 5, 100) for i in range(64)] + [(3 << 12 | 5, 5000)]
    size = spark.createDataFrame(rows, "h bigint, b bigint")
    leaf, leaves = exact_dedup.leaf_buckets(size, size, 400)
    got = {(r.h, r.leaf) for r in size.select("h", leaf.alias("leaf")).collect()}
    assert len(got) == 64 and max(x for _, x in got) < leaves  # a hash has one leaf
    sums = {}
    for h, b in rows:
        sums.setdefault(dict(got)[h], []).append((h, b))
    assert all(sum(b for _, b in x) <= 400 or len({h for h, _ in x}) == 1 for x in sums.values())
