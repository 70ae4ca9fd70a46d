"""Streaming ingest (C1 as a stream) and the driver contract."""

import __spark_entry__ as entry
from reelcat.functions.grammar import RECORD_TERMINATOR as T
from reelcat.streaming.ingest import latest_videos, start_ingest

PLAIN = "| 20240101 | 12 | 345 | 6 | A title | {id} | https://x.org/v | words"


def test_streaming_ingest_available_now(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "list_Chan_a.txt").write_text(f"{PLAIN.format(id='v1')} {T}\njunk {T}", encoding="utf-8")
    (landing / "list_Chan_b.txt").write_text(f"{PLAIN.format(id='v1').replace('A title', 'New')} {T}", encoding="utf-8")
    q = start_ingest(spark, str(landing), str(tmp_path / "videos"), str(tmp_path / "rejects"),
                     str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    v = latest_videos(spark, str(tmp_path / "videos")).collect()
    assert [(r["id"], r["title"], r["youtuber"]) for r in v] == [("v1", "New", "Chan")]
    assert spark.read.json(str(tmp_path / "rejects")).count() == 1


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "id" in df.columns
    qs, os_ = entry.queries(), entry.oracle_sql()
    assert set(os_) <= set(qs) and len(qs) >= 30


def test_streaming_ledger_updates(spark, tmp_path):
    import json

    from reelcat.sinks.tables import write_ledger
    from reelcat.streaming.ledger import latest_version, start_status_updates

    init = spark.createDataFrame([("@s", "a", "A", True, 1), ("@s", "b", "B", True, 2)],
                                 "subject_name string, video_id string, video_title string, is_link_found boolean, ledger_pos long")
    write_ledger(init, str(tmp_path / "initial"))
    landing = tmp_path / "status"
    landing.mkdir()
    rows1 = [{"subject_name": "@s", "video_id": "a", "video_title": "A2", "is_link_found": False, "ledger_pos": 10}]
    rows2 = [{"subject_name": "@t", "video_id": "c", "video_title": "C", "is_link_found": True, "ledger_pos": 11}]
    (landing / "s1.json").write_text("\n".join(json.dumps(r) for r in rows1))
    (landing / "s2.json").write_text("\n".join(json.dumps(r) for r in rows2))
    q = start_status_updates(spark, str(landing), str(tmp_path / "ledger"), str(tmp_path / "ckpt"),
                             initial_ledger=str(tmp_path / "initial"), files_per_batch=1, trigger_once=True)
    q.awaitTermination(180)
    got = sorted((r["subject_name"], r["video_id"], r["video_title"], r["is_link_found"])
                 for r in latest_version(spark, str(tmp_path / "ledger")).collect())
    assert got == [("@s", "a", "A2", False), ("@s", "b", "B", True), ("@t", "c", "C", True)]
