"""Record grammar (P1), entry handling (F6, F7) and counters (A3) on hand-written dumps."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reelcat.functions.grammar import _HEAD_JAVA, HEAD_PATTERN, RECORD_TERMINATOR, record_fields
from reelcat.functions.text import strip_ws
from reelcat.operators.parse import classify_entries, load_metrics, parsed_rows, rejected_rows
from reelcat.sources.dump import read_dump

T = RECORD_TERMINATOR
PLAIN = "| 20240101 | 12 | 345 | 6 | A title | vid-1 | https://x.org/v?1 | some words"


def parse_text(spark, text, compat=False, tmp_path=None, name="list_Chan_x.txt"):
    d = tmp_path / "dump"
    d.mkdir(exist_ok=True)
    (d / name).write_text(text, encoding="utf-8")
    return classify_entries(read_dump(spark, str(d)), compat=compat)


def one(spark, entry, compat=False):
    df = spark.createDataFrame([(entry,)], "e string")
    return df.select(*record_fields(strip_ws("e"), compat=compat)).first()


def test_plain_record(spark):
    r = one(spark, PLAIN)
    assert tuple(r) == ("20240101", "12", "345", "6", "A title", "vid-1", "https://x.org/v?1", "some words")


def test_pipes_in_title_land_in_title(spark):
    r = one(spark, "| d | 1 | 2 | 3 | A | B | vid | https://x.org/a | desc")
    assert r["title"] == "A | B" and r["id"] == "vid"


def test_empty_like_count_parses(spark):
    r = one(spark, "| d | 1 | 2 |  | T | vid | https://x.org/a | desc")
    assert r["like_count"] == "" and r["title"] == "T"


@pytest.mark.parametrize("views", ["", "1,234"])
def test_bad_view_count_rejected(spark, views):
    r = one(spark, f"| d | 1 | {views} | 3 | T | vid | https://x.org/a | desc")
    assert r["id"] is None


def test_text_before_first_pipe_rejected(spark):
    assert one(spark, "junk " + PLAIN)["id"] is None


def test_description_compat_and_clean(spark):
    assert one(spark, PLAIN.replace("some words", "see a_/b"))["description"] == "see a_/b"
    assert one(spark, PLAIN.replace("some words", "see a_/b"), compat=True)["description"] == "see a"
    assert one(spark, PLAIN.replace("some words", "hello"), compat=True)["description"] == "hello \\"
    assert one(spark, PLAIN.replace(" | some words", " |"), compat=True)["description"] == "\\"
    assert one(spark, PLAIN.replace(" | some words", " |"))["description"] == ""


def test_unicode_classes_and_whitespace(spark):
    r = one(spark, " | 2024 | 1 | é1 | 2 | Ünïcode | vid_é | https://x.org/é | multi\nline ")
    assert r["view_count"] == "é1" and r["id"] == "vid_é" and r["description"] == "multi\nline"


def test_head_agrees_with_the_format_on_random_entries(spark):
    rng = random.Random(5)
    bits = ["|", "|", "|", " ", "  ", "\n", "a", "-", "é", "12", "w w", "id-1", "https://", "https://x.org/v", "http://y|z", "\u00a0", "_/"]
    parts = ["d", "1", "2", "", "w", "a b", "id-1", "https://x.org/v", "https://x|y", "t | u", "é", "-"]
    entries = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 24))) for _ in range(2500)]
    entries += ["|" + "|".join(rng.choice(["", " ", "\n "]) + rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(6, 13))) + "| x" for _ in range(3500)]
    df = spark.createDataFrame([(e,) for e in entries], "e string")
    old = r"(?sU)\A" + HEAD_PATTERN
    rows = df.select("e", F.array(*[F.regexp_extract("e", old, i) for i in range(8)]).alias("a"),
                     F.array(*[F.regexp_extract("e", _HEAD_JAVA, i) for i in range(8)]).alias("b")).collect()
    assert sum(r["a"][0] != "" for r in rows) > 200
    assert [r for r in rows if r["a"] != r["b"]] == []


@pytest.mark.parametrize("entry", [
    "| " + " | ".join(f"w{i}" for i in range(160)),
    "| a | id1 | https://x.org/v" + " | word" * 45,
    "| a | id1 | https://x.org/v" + " | word" * 20_000,
    "| a | b | c |" + " " * 50_000 + "x",
    "| " + "w" * 100_000,
    "| a | b | c | d | e" + " | id | https://x y" * 5_000,
], ids=["no url", "342 characters", "20000 fields", "blanks", "one word", "broken urls"])
def test_long_unparsable_entry_is_rejected_quickly(spark, entry):
    one(spark, PLAIN)  # the first query of a session compiles
    t0 = time.time()
    assert one(spark, entry)["id"] is None
    assert time.time() - t0 < 2


def test_dump_scan_empties_rejects_and_unterminated_tail(spark, tmp_path):
    text = (f"{PLAIN} {T}\n   {T}\njunk {PLAIN} {T}\r\n"
            + PLAIN.replace("vid-1", "vid-2").replace("some words", "two\r\nlines"))  # no final terminator
    cls = parse_text(spark, text, tmp_path=tmp_path)
    got = {r["id"]: r for r in parsed_rows(cls).collect()}
    assert set(got) == {"vid-1", "vid-2"}
    assert got["vid-2"]["description"] == "two\nlines"
    assert got["vid-1"]["youtuber"] == "Chan"
    assert [r["reason"] for r in rejected_rows(cls).collect()] == ["rejected"]
    m = load_metrics(cls).first()
    assert (m["entries"], m["empty_entries"], m["parsed_entries"], m["rejected_entries"]) == (4, 1, 2, 1)
    assert m["distinct_ids"] == 2


def test_dump_without_channel_in_name_is_rejected(spark, tmp_path):
    cls = parse_text(spark, f"{PLAIN} {T}", tmp_path=tmp_path, name="dump.txt")
    assert [r["reason"] for r in rejected_rows(cls).collect()] == ["no_channel"]
    cls2 = classify_entries(read_dump(spark, str(tmp_path / "dump")), channel="Given")
    assert parsed_rows(cls2).first()["youtuber"] == "Given"


def test_entry_order_survives_many_splits(spark, tmp_path):
    recs = [PLAIN.replace("vid-1", f"v{i}").replace("some words", "x" * (i % 97)) for i in range(600)]
    d = tmp_path / "dump"
    d.mkdir()
    (d / "list_C_all.txt").write_text("".join(f"\n{r} {T}" for r in recs), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = read_dump(spark, str(d))
        assert raw.rdd.getNumPartitions() > 3
        out = parsed_rows(classify_entries(raw)).orderBy("source_file", "source_offset", "source_seq")
        assert [r["id"] for r in out.collect()] == [f"v{i}" for i in range(600)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
