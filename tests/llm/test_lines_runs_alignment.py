"""Line dedup, periodic runs and cross-tokenizer alignment against brute force, with the hard cases of their docstrings."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelcat.llm import align, line_dedup, periodic
from reelcat.llm.cuckoo import CuckooFilter

DOCS = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\x0c\r"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- cuckoo filter


def test_filter_holds_what_was_inserted_and_forgets_what_was_deleted():
    rng = np.random.RandomState(3)
    keys = rng.randint(0, 1 << 62, (20_000, 2)).astype(np.uint64)
    f = CuckooFilter(20_000)
    f.insert(keys[:12_000])
    f.insert(keys[12_000:])
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(keys).all()
    others = rng.randint(0, 1 << 62, (20_000, 2)).astype(np.uint64)
    assert f.contains(others).mean() < 0.002
    f.delete(keys[5_000:])
    assert f.contains(keys[:5_000]).all() and f.contains(keys[5_000:]).mean() < 0.002
    f.delete(keys[:5_000])
    assert not f.table.any() and not len(f.stash)


def test_filter_that_is_too_full_and_equal_keys():
    rng = np.random.RandomState(4)
    keys = rng.randint(0, 1 << 62, (600, 2)).astype(np.uint64)
    f = CuckooFilter(64)
    f.insert(keys)
    assert len(f.stash) and f.contains(keys).all()
    same = np.repeat(keys[:1], 12, axis=0)
    g = CuckooFilter(64)
    g.insert(same)
    for k in range(12):
        assert g.contains(same[:1]).all()
        g.delete(same[:1])
    assert not g.contains(same[:1]).any()
    f.delete(keys)
    assert not f.table.any() and not len(f.stash)


# ---------------------------------------------------------------- lines


def line_keys(text):
    keys = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACES)) for x in (text or "").split("\n")]
    return [k if len(k) >= 10 else None for k in keys]


def plain_lines(rows):
    top = 1 << 63
    keeper = {}
    for i, t in rows:
        for k in line_keys(t):
            keeper[k] = min(keeper.get(k, top), top - 1 if i is None else i)
    out = []
    for i, t in rows:
        lines, keys = (t or "").split("\n"), line_keys(t)
        kept = [x for x, k in zip(lines, keys) if k is None or keeper[k] >= (top - 1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def line_rows():
    rng = random.Random(9)
    lines = ["", "short", "a line of text", "  A Line of Text\t", "\x0bThe same, again and again\r", "exactly 10", "only nine", "é" * 10, "É" * 10, "日本" * 6, "x" * 50_000]
    lines += [f"line number {i}" for i in range(200)]
    rows = [(i, "\n".join(rng.choice(lines[:12] if rng.random() < 0.4 else lines) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    rows += [(i, "the line in a third of all rows\nown line %d" % i) for i in range(300, 450)]
    return rows + [(None, None), (None, "line number 7\nline number 7"), (None, "null only, held twice\nabcdefghijk"), (None, "null only, held twice"),
                   (5, "line number 3\nshared id line"), (5, "shared id line\n"), (700, ""), (701, None), (702, "\n" * 40), rows[10], rows[10]]


def verdicts(held, dropped):
    n = {(r.id, r.digest): len(r.lines) for r in dropped.collect()}
    return sorted((r.id, r.n_lines, n.get((r.id, r.digest), 0)) for r in held.collect())


def told(rows):
    return sorted((line_dedup.LARGEST if i is None else i, n, d) for i, n, d, _ in plain_lines(rows))


@pytest.mark.parametrize("increments", [1, 3])
def test_lines_against_a_dictionary(spark, increments):
    rows = line_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("lines", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("t", F.lit(0))
    _, held, dropped = line_dedup.line_dedup(df, increments=increments)
    assert verdicts(held, dropped) == told(rows)
    cut = line_dedup.cleaned(df, dropped).select("row.doc_id", "row.lines", "n_dropped", F.sha2("kept", 256).alias("kept")).collect()
    want = Counter((i, d, k) for i, _, d, k in plain_lines(rows) if d)
    assert Counter((r.doc_id, r.n_dropped, r.kept) for r in cut) == want and cut[0].lines == "clash"


def test_documents_come_and_go(spark):
    rows = line_rows()
    first = [r for r in rows if r[0] is None or r[0] % 3 != 1]
    later = [r for r in rows if r[0] is not None and r[0] % 3 == 1]
    held = line_dedup.held_lines(spark.createDataFrame(first, DOCS))
    more = line_dedup.held_lines(spark.createDataFrame(later, DOCS))
    base = line_dedup.LineIndex.empty(spark).insert(held)
    both = base.insert(more)
    assert verdicts(both.held, both.dropped(both.held)) == told(rows)
    back = both.delete(spark.createDataFrame([(i,) for i in {r[0] for r in later}], "any bigint"))
    table = lambda x: sorted((bytes(r.key), r.n, r.keeper) for r in x.counts.collect())
    assert table(back) == table(base)  # an insertion that is deleted leaves what was there
    assert verdicts(back.held, back.dropped(back.held)) == told(first)
    sizes = {r.shard: r["keys"] for r in back.filters.collect() if r["keys"]}
    assert sizes == {r.shard: r.n for r in back.counts.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    gone = both.delete(spark.createDataFrame([(None,)] + [(i,) for i in range(0, 200)], "id bigint"))  # the smallest holders go
    rest = [r for r in rows if r[0] is not None and not 0 <= r[0] < 200]
    assert verdicts(gone.held, gone.dropped(gone.held)) == told(rest)
    again = gone.insert(line_dedup.held_lines(spark.createDataFrame([r for r in rows if r not in rest], DOCS)))
    assert verdicts(again.held, again.dropped(again.held)) == told(rows)


def test_filters_grow_and_every_key_is_found(spark):
    parts = [[(100 * p + i, "\n".join(f"part {p} document {i} line {j}" for j in range(40))) for i in range(40)] for p in range(3)]
    index = line_dedup.LineIndex.empty(spark)
    for p in parts:
        index = index.insert(line_dedup.held_lines(spark.createDataFrame(p, DOCS)))
    capacity = {r.shard: (r.capacity, r["keys"]) for r in index.filters.collect()}
    assert sum(k for _, k in capacity.values()) == 4800 and all(k <= c for c, k in capacity.values())
    probed = index._counted(index.held).groupBy("shard").cogroup(index.filters.drop("keys", "capacity").groupBy("shard"))
    assert probed.applyInArrow(line_dedup._probe, f"{line_dedup.COUNTS}, maybe boolean").where("NOT maybe").count() == 0


def test_lines_of_an_empty_table(spark):
    _, held, dropped = line_dedup.line_dedup(spark.createDataFrame([], DOCS))
    assert held.count() == 0 and dropped.count() == 0


# ---------------------------------------------------------------- runs


def plain_runs(words, min_length=6, min_exponent=4):
    n, found = len(words), set()
    for q in range(1, n // min_exponent + 1):
        k = 0
        while k < n - q:
            j = k
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - k + q
            part = words[k : k + size]
            if j > k and size >= max(min_length, min_exponent * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                found.add((k, size, q))
            k = max(j, k + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = []
    while len(words) < rng.randint(0, 70):
        root = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randint(1, 6))]
        words += (root * 9)[: rng.randint(1, 9 * len(root))]
    return words


def test_lyndon_arrays_and_groups():
    rng = random.Random(2)
    for _ in range(200):
        w = [rng.randint(0, rng.choice([0, 1, 2])) for _ in range(rng.randint(0, 22))]
        length, group = periodic.lyndon_groups(w)
        for i in range(len(w)):
            assert length[i] == max(n for n in range(1, len(w) - i + 1) if all(w[i : i + n] < w[i + k : i + n] for k in range(1, n)))
            assert all((group[i] == group[j]) == (w[i : i + length[i]] == w[j : j + length[j]]) for j in range(i))


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (3, 3), (9, 5)])
def test_runs_against_all_periods(spark, min_length, min_exponent):
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(400)] + [["w"] * 3000, ["a", "b"] * 900 + ["a"]]
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(t)) for i, t in enumerate(texts)] + [(None, None), (None, ""), (3, "a " * 9), (3, "a " * 9), (9000, "\x0b \r")]
    df = spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit("clash")).repartition(3)
    got = Counter((r.key, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in
                  periodic.periodic_runs(df, min_length=min_length, min_exponent=min_exponent).collect())
    want = Counter()
    for i, t in rows:
        words = (t or "").split()
        runs = plain_runs(words, min_length, min_exponent) if len(words) < 1000 else [(0, len(words), len(set(words)))]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[(i, len(words), tuple(runs), " ".join(w for k, w in enumerate(words) if k not in gone))] += 1
    assert got == want
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_planted_runs_query(spark, tmp_path):
    rng = random.Random(6)
    vocab = ["w%d" % i for i in range(30)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 120)))) for i in range(300)] + [(7, None), (None, "b b b b b b b"), (-3, "x")]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in periodic.op11_periodic_runs(spark, str(tmp_path)).collect())
    want, planted = Counter(), 0
    for i, t in rows:
        words = (t or "").split()
        h, n = (zlib.crc32(str(i).encode()), len(words)) if i is not None else (1, 0)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        want[(i, len(runs), s, m, q, 1000 * m // q if m else None, sha("".join("%d,%d,%d\n" % r for r in runs)),
              sha(" ".join(w for k, w in enumerate(words) if k not in gone)))] += 1
    assert got == want and planted > 15 and sum(1 for r in got if r[1]) > 8


# ---------------------------------------------------------------- alignment


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(align.BYTE_BPE)
    tok.encode_special_tokens = True
    to_byte = align.byte_level()
    sp = sentencepiece.SentencePieceProcessor(model_file=align.PIECE_BPE)
    a_bytes = {i: bytes(to_byte[c] for c in e) for e, i in tok.get_vocab(with_added_tokens=False).items()}
    b_bytes = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
    cut, holders = [], defaultdict(int)
    for _, text in rows:
        whole, groups = (" " + (text or "")).encode(), []
        a = tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        if text and b"".join(a_bytes[i] for i in a) == whole == b"".join(b_bytes[i] for i in b):
            j = y = x = 0
            ga, gb = [], []
            for i in a:  # walk both sides byte by byte
                x += len(a_bytes[i])
                ga.append(i)
                while j < len(b) and y + len(b_bytes[b[j]]) <= x:
                    y += len(b_bytes[b[j]])
                    gb.append(b[j])
                    j += 1
                if x == y:
                    groups.append((ga, gb))
                    ga, gb = [], []
            assert not ga and not gb
        links = Counter((p, q) for ga, gb in groups for p in ga for q in gb)
        for pair in links:
            holders[pair] += 1
        cut.append((groups, links))
    most = defaultdict(int)
    for (p, _), n in holders.items():
        most[p] = max(most[p], n)
    out = []
    for (i, _), (groups, links) in zip(rows, cut):
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
                    sum(n for (p, q), n in links.items() if holders[p, q] == most[p]), sum(n * holders[pair] for pair, n in links.items()), sha(shown) if groups else ""))
    return Counter(out)


def hard_texts(rng):
    bits = ["word", "Wörter", "日本語", "🙂", "👩‍👩‍👧", "  ", " ", "\n", "\n\n", "\t", " \n", "<|endoftext|>", "<s>", "</s>", "<0x41>", "don't", "123,456", "é", "é", "ﬁ", " ", "　", "=====", "naïveté", "x" * 40, "ZWJ‍"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    return texts + ["", None, " ", "\n", "▁", "a▁b", "a  b", " lead", "trail ", "a" * 30_000, "ab " * 20_000, "=" * 5000, " " * 3000, "日" * 4000, "\x00", "a\r\nb", "<unk>"]


@pytest.mark.parametrize("common", [1_000_000, 40, 0])
def test_alignment_against_walking_both_sides(spark, monkeypatch, common):
    rng = random.Random(11)
    rows = list(enumerate(hard_texts(rng))) + [(None, "word word"), (None, "word"), (2, "same row"), (2, "same row"), (-5, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("pairs", F.lit("clash")).withColumn("r", F.lit(0)).repartition(4)
    out = align.alignment(df, common=common)
    got = Counter((r.key, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out.collect())
    want = plain_alignment(rows)
    assert got == want


def test_alignment_query_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = Counter(tuple(r) for r in align.op13_cross_tokenizer_alignment(spark, SF).select(names).collect())
    assert got == plain_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert align.alignment(spark.createDataFrame([], DOCS)).count() == 0


def test_products_are_listed_some_groups_at_a_time(monkeypatch):
    ga, gb = np.array([0, 0, 1, 1, 1, 2]), np.array([0, 1, 1, 2, 2])
    a, b = np.array([5, 5, 7, 8, 7, 9]), np.array([1, 2, 3, 4, 4])
    whole = [tuple(map(int, x)) for part in align._products(align._counted(ga, a), align._counted(gb, b), 3, 10) for x in zip(*part)]
    monkeypatch.setattr(align, "PAIRS", 1)
    cut = [tuple(map(int, x)) for part in align._products(align._counted(ga, a), align._counted(gb, b), 3, 10) for x in zip(*part)]
    assert sorted(whole) == sorted(cut) == [(0, 51, 2), (1, 72, 2), (1, 73, 2), (1, 82, 1), (1, 83, 1), (2, 94, 2)]
