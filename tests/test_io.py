"""Sinks and sources: keyed JSON documents (K2/K3), names (K4), catalogs, ledgers, inventories."""

import glob
import json
import os

from pyspark.sql import functions as F

from reelcat.schemas import RECORD_FIELDS
from reelcat.sinks import tables as K
from reelcat.sources import files as S

REC = "upload_date string, duration string, view_count string, like_count string, title string, id string, webpage_url string, description string"


def concat_doc(folder):
    parts = sorted(glob.glob(os.path.join(folder, "part-*")))
    return "\n".join(open(p, encoding="utf-8").read().rstrip("\n") for p in parts)


def test_manifest_documents_are_the_reference_object(spark, tmp_path):
    data = [("d", "1", "2", "3", f"title é {i}", f"v{i}", "u", None, "@s") for i in range(50)]
    rows = spark.createDataFrame(data, REC + ", subject_name string").withColumn("manifest_name", F.lit("m1"))
    out = str(tmp_path / "out")
    K.write_manifest_documents(rows.repartition(7), ["a", "b"], out)
    doc = json.loads(concat_doc(os.path.join(out, "manifest_name=m1")))
    assert doc["search_terms"] == ["a", "b"]
    assert len(doc["videos"]) == 50 and doc["videos"]["v3"]["title"] == "title é 3"
    assert doc["videos"]["v3"]["description"] is None and doc["videos"]["v3"]["subject_name"] == "@s"


def test_manifest_documents_read_back_as_rows(spark, tmp_path):
    data = [("d", "1", "2", "3", f"t{i}", f"v{i}", "u", "x", "@s") for i in range(5)]
    rows = spark.createDataFrame(data, REC + ", subject_name string").withColumn("manifest_name", F.lit("m"))
    out = str(tmp_path / "out")
    K.write_manifest_documents(rows, None, out)
    land = tmp_path / "landed"
    land.mkdir()
    (land / "videos_all_matching_Download_ready.json").write_text(concat_doc(os.path.join(out, "manifest_name=m")))
    back = S.read_manifest_documents(spark, str(land))
    assert back.count() == 5 and {r["search_terms"] for r in back.collect()} == {"All videos processed"}
    assert back.where("id = 'v3'").first()["subject_name"] == "@s"


def test_catalog_documents_roundtrip_through_legacy_reader(spark, tmp_path):
    data = [("d", "1", "2", "3", f"t{i}", f"v{i}", f"https://x/{i}", "desc", "cat_A_VideosObject.json") for i in range(20)]
    rows = spark.createDataFrame(data, REC + ", catalog_file string")
    out = str(tmp_path / "docs")
    from reelcat.sinks.documents import write_documents

    write_documents(K.catalog_documents(rows, rows), "catalog_file", out)
    text = concat_doc(os.path.join(out, "catalog_file=cat_A_VideosObject.json"))
    doc = json.loads(text)
    assert set(doc) == {"videos", "urls"} and doc["urls"]["https://x/3"] == "v3"
    land = tmp_path / "landed"
    land.mkdir()
    (land / "cat_A_VideosObject.json").write_text(text, encoding="utf-8")
    back = S.read_catalog_documents(spark, str(land))
    assert back.count() == 20 and back.where("id = 'v5'").first()["title"] == "t5"


def test_unique_path_never_overwrites(spark, tmp_path):
    base = "videos_all_20250101_matching_Download_ready"
    p1 = K.unique_path(spark, str(tmp_path), base, ".json")
    assert p1.endswith(base + ".json")
    open(p1, "w").close()
    p2 = K.unique_path(spark, str(tmp_path), base, ".json")
    assert p2.endswith(base + "_2.json")
    open(p2, "w").close()
    assert K.unique_path(spark, str(tmp_path), base, ".json").endswith(base + "_3.json")


def test_ledger_csv_reader_keeps_text_ids_and_missing_is_empty(spark, tmp_path):
    d = tmp_path / "dl" / "@chan"
    d.mkdir(parents=True)
    (d / "download_status.csv").write_text("video_id,video_title,is_link_found\n0123,NA,False\nabc,T,True\n")
    led = S.read_ledger(spark, str(tmp_path / "dl"))
    got = sorted((r["subject_name"], r["video_id"], r["video_title"], r["is_link_found"]) for r in led.collect())
    assert got == [("@chan", "0123", "NA", False), ("@chan", "abc", "T", True)]
    assert S.read_ledger(spark, str(tmp_path / "missing")).count() == 0


def test_inventory_from_folders(spark, tmp_path):
    base = tmp_path / "media"
    (base / "@s" / "HighQuality").mkdir(parents=True)
    (base / "@s" / "HighQuality" / "v1.mp4").write_bytes(b"x")
    (base / "@s" / "Title.MP4").write_bytes(b"yy")
    (base / "@t").mkdir()
    (base / "@t" / "note.txt").write_bytes(b"z")
    inv = S.read_inventory(spark, str(base))
    got = sorted((r["subject_name"], r["quality_dir"] or "", r["filename"]) for r in inv.collect())
    assert got == [("@s", "", "Title.MP4"), ("@s", "HighQuality", "v1.mp4"), ("@t", "", "note.txt")]
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_catalog_rows_roundtrip_keeps_hidden_looking_names(spark, tmp_path):
    data = [("d", "1", "2", "3", "t", "v1", "u", "x", 1, "_Chan_VideosObject.json")]
    rows = spark.createDataFrame(data, REC + ", entry_pos long, catalog_file string")
    out = str(tmp_path / "cat")
    K.write_catalog_rows(rows, out)
    back = S.read_catalog_rows(spark, out)
    assert [tuple(r[c] for c in ("catalog_file", "id")) for r in back.collect()] == [("_Chan_VideosObject.json", "v1")]


def test_ledger_versions_switch(spark, tmp_path):
    led = spark.createDataFrame([("@s", "a", "t", True, 1)],
                                "subject_name string, video_id string, video_title string, is_link_found boolean, ledger_pos long")
    base = str(tmp_path / "ledger")
    assert K.current_ledger_path(spark, base) is None
    p1 = K.write_ledger_version(spark, led, base)
    p2 = K.write_ledger_version(spark, led.withColumn("is_link_found", F.lit(False)), base)
    assert p1.endswith("version=1") and p2.endswith("version=2")
    assert K.current_ledger_path(spark, base) == p2


def test_channel_selection_prunes_partitions(spark, tmp_path):
    from reelcat.operators.select import select_videos
    from reelcat.sources import derived

    out = str(tmp_path / "videos")
    K.write_videos(derived.videos(spark, "/root/testdata/sf0.001"), out, mode="overwrite")
    sel = select_videos(spark.read.parquet(out), channel="src3")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(youtuber" in plan and "src3" in plan
    assert sel.count() == derived.videos(spark, "/root/testdata/sf0.001").where("youtuber = 'src3'").count()


def test_dump_writer_roundtrip_and_pages_reader(spark, tmp_path):
    from reelcat.operators.parse import classify_entries, parsed_rows
    from reelcat.sinks.dump import dump_lines, write_dump
    from reelcat.sources.dump import read_dump

    data = [("d", "1", "2", "3", f"Title {i} | part", f"v{i}", f"https://x/{i}", f"line one\nline {i}") for i in range(30)]
    v = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "pos long, " + REC)
    out = str(tmp_path / "dump")
    write_dump(dump_lines(v), out, order_by=["value"])
    got = parsed_rows(classify_entries(read_dump(spark, out), channel="C"))
    assert sorted(tuple(r[c] for c in RECORD_FIELDS) for r in got.collect()) == sorted(data)

    from reelcat.sources.files import read_pages

    pages = spark.createDataFrame([(1, "https://h/a", "<html></html>")], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    assert read_pages(spark, str(tmp_path / "pages")).columns == ["page_id", "url", "html"]


def test_ledger_csv_keeps_titles_and_reads_what_pandas_writes(spark, tmp_path):
    import pandas as pd

    titles = [" pad ", 'He said ""hi"", ok', "two\nlines", "a,b", '"q"']
    led = spark.createDataFrame([("@s 100%", f"v{i}", t, i % 2 == 0, i) for i, t in enumerate(titles)],
                                "subject_name string, video_id string, video_title string, is_link_found boolean, ledger_pos long")
    K.write_ledger(led, str(tmp_path / "v1"))
    from reelcat.streaming.ledger import read_ledger_version

    assert sorted(tuple(r) for r in read_ledger_version(spark, str(tmp_path / "v1")).collect()) == sorted(tuple(r) for r in led.collect())
    folder = tmp_path / "base" / "@My Chan"
    folder.mkdir(parents=True)
    pd.DataFrame({"video_id": [f"v{i}" for i in range(5)], "video_title": titles, "is_link_found": [True, False] * 2 + [True]}).to_csv(folder / "download_status.csv", index=False)
    got = S.read_ledger(spark, str(tmp_path / "base")).orderBy("video_id").collect()
    assert [r.video_title for r in got] == titles and {r.subject_name for r in got} == {"@My Chan"} and not got[1].is_link_found
    assert S.read_ledger(spark, str(tmp_path / "none")).columns == S.read_ledger(spark, str(tmp_path / "base")).columns


def test_hidden_catalogs_are_read(spark, tmp_path):
    one = {"videos": {"v": {"id": "v", "title": "T"}}, "urls": {}}
    for name in ("_Name_VideosObject.json", "Other 100%_VideosObject.json"):
        (tmp_path / name).write_text(json.dumps(one))
    got = {r.catalog_file for r in S.read_catalog_documents(spark, str(tmp_path)).collect()}
    assert got == {"_Name_VideosObject.json", "Other 100%_VideosObject.json"}


def test_ledger_roundtrip_whole_returns_whole_titles(spark):
    from conftest import SF_CHECK
    from reelcat.plans import file_queries as Q
    from reelcat.sources import derived

    def shaped(r):
        return None if r.video_title is None else Q._TITLES[r.ledger_pos % 5].replace("%s", r.video_title) or None

    got = Q.q_ledger_roundtrip_whole(spark, SF_CHECK).collect()
    led = derived.link_status(spark, SF_CHECK).select("subject_name", "video_id", "video_title", "is_link_found", "ledger_pos").collect()
    assert max(len(r.video_title or "") for r in got) > 20 + max(map(len, Q._TITLES))
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((f"{r.subject_name} 100%", r.video_id, shaped(r), r.is_link_found)) for r in led)
