"""Chat formatting, language ID, WARC, mixing and SentencePiece: round trips, accuracy and brute force."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelcat.llm import chat, language, mixing, pieces, warc

# ---------------------------------------------------------------- chat

TURNS = "conv_id bigint, turn bigint, role string, text string"


def turns():
    rng = random.Random(8)
    bits = ["</s>", "[INST]", "<\\/s>", "[\\\\/INST]", "<|endoftext|>", "<", "[", "\\", "é", "🙂", "日本", " ", "\n", "word", "s>", ""]
    rows = [(None, 0, None, None), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(c, t, rng.choice(["user", "assistant", "system", "[/INST]", None]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for c in range(40) for t in range(rng.randint(1, 6))]
    return rows + [(50, 0, "assistant", "same"), (50, 0, "assistant", "same"), (51, 0, "user", "x" * 300_000), (51, None, "user", "first")]


@pytest.mark.parametrize("part_chars", [1 << 22, 30])
def test_conversations_read_back_as_they_went_in(spark, part_chars):
    rows = turns()
    df = spark.createDataFrame(rows, TURNS).withColumn("part", F.lit("clash")).withColumn("loss", F.lit(1)).repartition(3)
    out = chat.formatted(df, part_chars=part_chars)
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, ts in convs.items():
        ts = sorted(ts)
        learned = "".join(x for _, _, r, x in ts if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(ts), len(learned))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, _, a, b in ts).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.digests(chat.formatted(spark.createDataFrame([], TURNS))).count() == 0


def test_escapes_are_undone_and_hide_controls():
    for text in ["</s>", "<\\/s>", "[[INST]", "<<s>", "<\\\\s>", "plain", "<|endoftext|>"]:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


# ---------------------------------------------------------------- language


def test_a_rare_language_is_learned_beside_a_text_in_a_third_of_the_rows(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") < 33_000, "aa").when(F.col("id") < 99_970, "bb").otherwise("cc").alias("lang"),
        F.when(F.col("id") < 33_000, "mana kana tana").when(F.col("id") < 99_970, F.concat(F.lit("bole dole "), F.col("id"), F.lit(" gole")))
        .otherwise(F.concat(F.lit("zuzu xuxu "), F.col("id"), F.lit(" wuwu"))).alias("text"))
    got = {r.lang: r["count"] for r in language.sampled(rows, train_docs=600).groupBy("lang").count().collect()}
    assert got["aa"] == 1 and got["cc"] == 30 and 400 <= got["bb"] <= 700
    model = language.train(rows, train_docs=600)
    df = spark.createDataFrame([(1, "zuzu wuwu"), (2, "mana tana"), (3, "dole gole")], "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred for r in language.label_languages(df, model).select("row.doc_id", "lang_pred").collect()} == {1: "cc", 2: "aa", 3: "bb"}


def test_held_out_languages_and_spans(spark):
    out = language.op5_language_id(spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(lang, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_text_scripts_and_hard_cases(spark):
    words = {"xx": ["mano", "lino", "tamo", "rano"], "yy": ["drek", "stolk", "berk", "kralk"], "zz": ["мир", "дом", "река"]}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30)), k) for i in range(90) for k in [list(words)[i % 3]]]
    model = language.train(spark.createDataFrame(rows + [(900, "mano", None), (901, None, "xx")], "doc_id bigint, text string, lang string"))
    mixed = "mano lino tamo rano mano, 12 drek stolk berk kralk berk дом"
    docs = [(1, mixed), (2, None), (3, "12 !?"), (4, ""), (5, "x" * 200_000), (6, mixed), (6, mixed)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("lang_pred", F.lit("clash")).withColumn("row", F.lit(0))
    got = language.label_languages(df, model, switch_penalty=2.0).select("row.doc_id", "lang_pred", "score", "spans").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(docs)
    assert [(s.first_word, s.last_word, s.lang) for s in by[1].spans] == [(0, 4, "xx"), (6, 10, "yy"), (11, 11, "zz")]
    assert [by[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and by[2].spans == [] and by[6].spans == by[1].spans
    empty = language.train(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in language.label_languages(df, empty).collect()} == {"und"}


def test_viterbi_agrees_with_all_label_sequences():
    import itertools

    rng = np.random.RandomState(3)
    scores = rng.randn(6, 3).astype(np.float32) * 2
    sizes = [0, 1, 4, 6]
    code, off = rng.randint(0, 6, sum(sizes)), np.concatenate(([0], np.cumsum(sizes)))
    got = language.viterbi(scores, code, off, 1.5)
    for a, b in zip(off, off[1:]):
        best = max(itertools.product(range(3), repeat=int(b - a)), key=lambda s: sum(scores[c, k] for c, k in zip(code[a:b], s)) - 1.5 * sum(x != y for x, y in zip(s, s[1:])))
        assert tuple(got[a:b]) == best


# ---------------------------------------------------------------- WARC

PAGES = "page_id bigint, url string, html string"


def test_archives_give_the_pages_back(spark, tmp_path):
    body = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx</p>é"
    rows = [(5, "https://a.org/x y", body), (2, "https://a.org/2", body), (9, None, body), (1, "u\r\nv", ""), (3, "https://b.org", None), (4, "h", "z" * 200_000),
            (4, "h", "z" * 200_000), (None, "https://c.org", "only"), (None, "https://c.org", body)]
    df = spark.createDataFrame(rows, PAGES).withColumn("id", F.lit("clash")).withColumn("content", F.lit(1)).repartition(2)
    path = str(tmp_path / "w")
    warc.write_archives(df, path)
    records = warc.read_archives(spark, path)
    assert {r["type"]: r["count"] for r in records.groupBy("type").count().collect()} == {"request": 9, "response": 5, "revisit": 4, "metadata": 9}
    got = warc.assemble(records).collect()
    assert len(got) == 9 and all(r.request and r.metadata for r in got)
    payloads = sorted(bytes(r.response.block)[r.response.http_head :].decode() for r in got if r.response.type == "response")
    assert payloads == sorted(["", body, "z" * 200_000, "z" * 200_000, "only"])
    assert {r.response.target_uri for r in got if r.response.type == "revisit"} == {"https://a.org/x y", None, "https://b.org", "https://c.org"}
    empty = str(tmp_path / "e")
    warc.write_archives(spark.createDataFrame([], PAGES), empty)
    assert warc.assemble(warc.read_archives(spark, empty)).count() == 0


def test_compressed_and_broken_archives():
    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 4\r\n\r\na\r\nb\r\n\r\n"
    assert [b for _, b in warc.parse_records(one * 2)] == [b"a\r\nb"] * 2
    assert [b for _, b in warc.parse_records(gzip.compress(one) + gzip.compress(one))] == [b"a\r\nb"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(one[:-8]))


# ---------------------------------------------------------------- mixing


def mix_rows():
    rng = random.Random(2)
    sizes = {"big": 300, "mid": 60, "low": 20, None: 8, "": 5}
    rows = [(s, "w " * rng.randint(1, 60)) for s, n in sizes.items() for _ in range(n)] + [("big", None), ("low", " ")]
    return [(i, t, s) for i, (s, t) in enumerate(rows)] + [(0, rows[0][1], "big")] * 2


def test_budgets_epochs_and_weights(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("tokens", F.lit(-5)).withColumn("times", F.lit("clash"))
    for mix in (mixing.Mix(block_tokens=200), mixing.Mix(None, 1.5, None, 100), mixing.Mix(0.9, None, 6000, 150)):
        out = mixing.mixed(df, mix).select("row.doc_id", "source", "tokens", "epoch", "weight", "mix_position").collect()
        there, taken, weight = {}, {}, {}
        for _, t, s in rows:
            there[s] = there.get(s, 0) + len((t or "").split())
        for r in out:
            taken[r.source] = taken.get(r.source, 0) + r.tokens
            if r.tokens:
                weight[r.source] = r.weight
        assert abs(sum(weight.values()) - 1) < 1e-6
        total = sum(there.values())
        budget = mix.budget_tokens or max(n / weight[s] for s, n in there.items())
        for s, n in there.items():  # a source goes over its budget by the document that crosses it
            assert weight[s] * budget - 2 <= taken[s] <= weight[s] * budget + 200
        if mix.budget_tokens is None:
            assert {r.doc_id for r in out} == {r[0] for r in rows}
        entropy = -sum(w * np.log(w) for w in weight.values())
        rep = max(weight[s] / n for s, n in there.items()) / (min(weight[s] / n for s, n in there.items()) if mix.budget_tokens is None else 1 / budget)
        if mix.target_entropy is not None:
            assert entropy <= mix.target_entropy * np.log(len(there)) + 1e-6
        if mix.repetition_limit is not None:
            assert rep <= mix.repetition_limit + 1e-6
        assert sorted(r.doc_id for r in out if r.tokens == 0) == [393, 394] and total
        assert all(0 <= r.mix_position < 1 for r in out)


def test_a_mix_agrees_with_its_sql(spark, tmp_path):
    import duckdb

    rows = [r for r in mix_rows() if r[0]]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = {(r[0], r[3], r[4]): (r[5], r[6]) for r in con.execute(mixing.ORACLE).fetchall()}
    got = {(r.doc_id, r.epoch, r.block): (r.weight, r.mix_position) for r in mixing.op8_mixing(spark, str(tmp_path)).collect()}
    assert got == want and len(got) > len(rows)
    assert mixing.mixed(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0


# ---------------------------------------------------------------- SentencePiece


def plain_viterbi(text, scores, byte_ids, longest):
    if not text:
        return []
    c = [None if x == "▁" else "▁" if x == " " else x for x in " " + text]
    best, back = [0.0], [None]
    for e in range(1, len(c) + 1):
        top, how = best[e - 1] + pieces.BYTES_SCORE, (1, None)
        for n in range(1, min(longest, e) + 1):
            part = c[e - n : e]
            p = None if None in part else scores.get("".join(part))
            if p and best[e - n] + p[1] >= top:
                top, how = best[e - n] + p[1], (n, p[0])
        best.append(top)
        back.append(how)
    out, e = [], len(c)
    while e:
        n, i = back[e]
        raw = "▁" if c[e - 1] is None else " " if c[e - 1] == "▁" else c[e - 1]
        out[:0] = [byte_ids[b] for b in raw.encode()] if i is None else [i]
        e -= n
    return out


def test_pieces_agree_with_plain_viterbi_and_decode_exactly(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    scores = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    v = pieces.vocabulary()
    rng = random.Random(1)
    texts = ["", None, " ", "a", "Hello  world\nfoo ▁x", "\n\n a\r\n\tb", "x" * 300, "日本語🙂 ok", "  lead", "trail  ", "é" * 70 + " " * 40, "\x00"]
    texts += ["".join(rng.choice("ab c\n▁é日🙂 the") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(0))
    got = pieces.decode(pieces.encode(df)).select("row.text", "ids", "decoded").collect()
    assert len(got) == len(texts)
    for r in got:
        assert list(r.ids) == plain_viterbi(r.text, scores, [int(x) for x in v.byte_ids], v.longest) and r.decoded == (r.text or "")
    both = pieces.encode(df, with_decoded=True).select("row.doc_id", "ids", "decoded").collect()
    assert all(r.decoded == (texts[r.doc_id] or "") for r in both)
    assert pieces.encode(df.limit(0)).count() == 0


def test_a_very_long_word_round_trips(spark):
    text = "ab1é" * 40_000
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pieces.decode(pieces.encode(df)).first().decoded == text


def test_rows_without_an_id_of_their_own_are_taken_one_by_one(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 10 == 1 else i, "w " * 10, "ab"[i % 2]) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    for budget in (12_000, 6_000, 3_000):
        mix = mixing.Mix(None, 1.0, budget, 200)
        got = mixing.mixed(df, mix).select("row.doc_id", "source", "tokens").collect()
        for s in "ab":  # two sources of 6,000 tokens each: half the budget of each, to one row
            assert abs(sum(r.tokens for r in got if r.source == s) - budget / 2) <= 10
    assert 60 < sum(r.doc_id is None for r in got) < 140  # of 300 rows taken, about a third


def test_archives_are_cut_by_bytes(spark, tmp_path):
    import os

    rng = random.Random(13)
    sizes = [1 << 20] * 40 + [rng.randint(0, 3000) for _ in range(400)] + [200_000] * 30 + [9 << 20]
    rows = [(i, f"http://h.org/{i}", f"{i:09d}" + "x" * max(0, n - 9)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, PAGES).repartition(2)
    warc.write_archives(df, str(tmp_path / "w"), file_bytes=4 << 20)
    files = [os.path.getsize(f) for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert sum(n > 4 << 20 for n in files) == 1 and sum(files) > sum(sizes)  # the page of 9 MB alone
    got = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).select("response.target_uri", F.length(warc.payload_of("response")).alias("n")).collect()
    assert {(r.target_uri, r.n) for r in got} == {(u, len(b)) for _, u, b in rows} and len(got) == len(rows)
