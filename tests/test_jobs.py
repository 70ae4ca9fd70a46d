"""The user-level jobs C1-C8 end to end on small hand-made inputs."""

import glob
import json
import os

from pyspark.sql import functions as F

from reelcat.functions.grammar import RECORD_TERMINATOR as T
from reelcat.operators.pages import CRAWLED
from reelcat.plans import jobs

REC = "| 2024010{n} | {dur} | 1{n}0 | 5 | {title} | v{n} | https://m.org/watch?v=v{n} | about {n}"


def write_dump(folder, name, recs):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"\n{r} {T}" for r in recs), encoding="utf-8")


def concat_doc(folder):
    parts = sorted(glob.glob(os.path.join(folder, "part-*")))
    return json.loads("\n".join(open(p, encoding="utf-8").read().rstrip("\n") for p in parts))


def test_ingest_and_catalog_jobs(spark, tmp_path):
    d = tmp_path / "dumps"
    write_dump(d, "list_Chan_Videos.txt", [REC.format(n=1, dur="10", title="First"), "junk",
                                           REC.format(n=2, dur="NA", title="Second"),
                                           REC.format(n=1, dur="11", title="First again")])
    m = jobs.ingest_dump(spark, str(d), str(tmp_path / "videos"), str(tmp_path / "rejects"))
    assert (m["parsed_entries"], m["rejected_entries"], m["distinct_ids"]) == (3, 1, 2)
    videos = spark.read.parquet(str(tmp_path / "videos"))
    assert videos.where("youtuber = 'Chan'").count() == 3
    jobs.ingest_dump(spark, str(d), str(tmp_path / "videos"))  # appended again: not idempotent ...
    assert spark.read.parquet(str(tmp_path / "videos")).count() == 6
    latest = {r["id"]: r["title"] for r in jobs.latest_videos(spark, str(tmp_path / "videos")).collect()}
    assert latest == {"v1": "First again", "v2": "Second"}  # ... dedup on read

    jobs.build_catalog(spark, str(d), str(tmp_path / "catalogs"), documents_path=str(tmp_path / "docs"))
    rows = spark.read.parquet(str(tmp_path / "catalogs"))
    got = {r["id"]: r["title"] for r in rows.collect()}
    assert got == {"v1": "First again", "v2": "Second"}
    assert rows.first()["catalog_file"] == "_Chan_Videos_VideosObject.json"
    doc = concat_doc(str(tmp_path / "docs" / "catalog_file=_Chan_Videos_VideosObject.json"))
    assert doc["videos"]["v1"]["duration"] == "11" and doc["urls"]["https://m.org/watch?v=v2"] == "v2"

    path = jobs.reduce_catalogs(spark, str(tmp_path / "catalogs"), str(tmp_path), terms=["again"])
    red = concat_doc(os.path.join(path, "manifest_name=_Chan_Videos_VideosObject_matching_Download_ready"))
    assert red["search_terms"] == ["again"] and list(red["videos"]) == ["v1"]
    assert red["videos"]["v1"]["subject_name"] == "@Chan"


def test_select_videos_job_writes_versioned_manifests(spark, tmp_path):
    v = spark.createDataFrame(
        [(1, "d", None, "1", "", "Leg day", "v1", "u1", None, "Chan"), (2, "d", "5", "1", "", "Arms", "v2", "u2", "x", None)],
        "entry_pos long, upload_date string, duration string, view_count string, like_count string, title string,"
        " id string, webpage_url string, description string, youtuber string")
    p1 = jobs.select_videos(spark, v, str(tmp_path))
    p2 = jobs.select_videos(spark, v, str(tmp_path))
    assert p2 == p1 + "_2"
    doc = concat_doc(os.path.join(p1, "manifest_name=" + os.path.basename(p1)))
    assert doc["search_terms"] == "All videos processed"
    assert doc["videos"]["v1"]["duration"] == "NA" and doc["videos"]["v2"]["subject_name"] == "@None"


def test_plan_record_rename_and_pages_jobs(spark, tmp_path):
    man = spark.createDataFrame([("a", "Alpha", "@s", "10"), ("b", "Beta", "@s", "NA"), ("c", "Gamma", "@s", "5")],
                                "id string, title string, subject_name string, duration string")
    inv = spark.createDataFrame([("@s", "a.mp4", "HighQuality", 1), ("@s", "old Gamma cut.mp4", None, 2)],
                                "subject_name string, filename string, quality_dir string, modification_time long")
    led = spark.createDataFrame([("@s", "b", "Beta", True, 1)],
                                "subject_name string, video_id string, video_title string, is_link_found boolean, ledger_pos long")
    out = jobs.plan_downloads(man, inv, led)
    assert [r["id"] for r in out["work"].collect()] == ["b"]
    tot = {r["subject_name"]: r["duration_total"] for r in out["durations"].collect()}
    assert tot == {"@s": 15.0, None: 15.0}

    batch = spark.createDataFrame([("@s", "b", "Beta", False, 9)], led.schema)
    new = jobs.record_status(spark, led, batch, str(tmp_path / "ledger_v2"))
    assert [(r["video_id"], r["is_link_found"]) for r in new.collect()] == [("b", False)]

    cur = spark.createDataFrame([("@s", "b", "Beta")], "subject_name string, id string, title string")
    ren = jobs.plan_renames(inv, cur).collect()
    assert [(r["from_name"], r["to_name"]) for r in ren] == [("old Gamma cut.mp4", "b.mp4")]

    pages = spark.createDataFrame(
        [(1, "https://h.org/en/512?utm_source=x",
          '<html lang="en"><title>T &amp; U</title><nav><ul><li><a href="/a">the a</a></li><li><a href="/b">b</a></li></ul></nav>'
          '<div class="ad">the failure</div></html>')], "page_id long, url string, html string")
    f = jobs.page_fields(pages, CRAWLED).first()
    assert (f["container_link"], f["group_link"], f["text_link"], f["page_title"]) == ("https://h.org/a",) * 3 + ("T & U",)
    assert (f["is_failure"], f["has_notice"], f["label_value"], f["above_threshold"], f["url_filename"]) == (True, False, None, False, "512")


def test_readme_flow_end_to_end(spark, tmp_path):
    from reelcat.operators.manifest import select_manifest
    from reelcat.sources.files import read_inventory, read_ledger

    d = tmp_path / "dumps"
    write_dump(d, "list_Chan_A.txt", [REC.format(n=1, dur="10", title="Leg day one"),
                                      REC.format(n=2, dur="7", title="Leg day two"),
                                      REC.format(n=3, dur="5", title="Squat form"),
                                      REC.format(n=4, dur="5", title="Arms")])
    jobs.ingest_dump(spark, str(d), str(tmp_path / "videos"))
    videos = jobs.latest_videos(spark, str(tmp_path / "videos"))
    manifest = select_manifest(videos, terms=["leg day", "squat"], order=jobs.INGEST_ORDER)
    media = tmp_path / "media" / "@Chan"
    (media / "HighQuality").mkdir(parents=True)
    (media / "HighQuality" / "v1.mp4").write_bytes(b"x")            # v1 held
    (media / "Squat form.mp4").write_bytes(b"x")                      # v3 skipped by title
    (media / "download_status.csv").write_text("video_id,video_title,is_link_found\nv2,Leg day two,False\n")
    plan = jobs.plan_downloads(manifest, read_inventory(spark, str(tmp_path / "media")),
                               read_ledger(spark, str(tmp_path / "media")), ledger_order=jobs.LEDGER_FILE_ORDER)
    assert [r["id"] for r in plan["work"].collect()] == []          # v2 gated by its ledger status
    assert {r["subject_name"]: r["duration_total"] for r in plan["durations"].collect()} == {"@Chan": 22.0, None: 22.0}


def test_catalog_sections_fill_independently_and_need_no_channel(spark, tmp_path):
    d = tmp_path / "dump"
    d.mkdir()
    rec = "| d | 1 | 2 | 3 | T{0} | v{1} | https://m.org/{2} | x \\_/"
    (d / "all.txt").write_text(rec.format(1, 1, "a") + rec.format(2, 2, "a") + rec.format(3, 3, "b") + rec.format(4, 3, "c"))
    (d / "list_empty.txt").write_text("nothing here \\_/")
    m = jobs.build_catalog(spark, str(d), str(tmp_path / "rows"), documents_path=str(tmp_path / "docs"), rejects_path=str(tmp_path / "rejects"))
    assert (m["parsed_entries"], m["rejected_entries"]) == (4, 1)
    doc = concat_doc(str(tmp_path / "docs" / "catalog_file=_VideosObject.json"))
    assert set(doc["videos"]) == {"v1", "v2", "v3"} and doc["urls"] == {"https://m.org/a": "v2", "https://m.org/b": "v3", "https://m.org/c": "v3"}
    empty = concat_doc(str(tmp_path / "docs" / "catalog_file=_empty_VideosObject.json"))
    assert empty == {"videos": {}, "urls": {}}


def test_a_selection_without_a_hit_writes_an_empty_manifest(spark, tmp_path):
    v = spark.createDataFrame([], "entry_pos long, upload_date string, duration string, view_count string, like_count string, title string,"
                              " id string, webpage_url string, description string, youtuber string")
    path = jobs.select_videos(spark, v, str(tmp_path), terms=["zzz"])
    assert concat_doc(os.path.join(path, "manifest_name=" + os.path.basename(path))) == {"search_terms": ["zzz"], "videos": {}}


def test_renames_never_share_a_target(spark):
    inv = spark.createDataFrame([("@a", "videoplayback.mp4", None, 5), ("@b", "videoplayback.mp4", None, 1), ("@b", "new.mp4", None, 2),
                                 ("@c", "old.mp4", None, 2), ("@c", "c.mp4", None, 1), ("@d", "D", "HighQuality", 1)],
                                "subject_name string, filename string, quality_dir string, modification_time long")
    cur = spark.createDataFrame([("@a", "a", "A"), ("@b", "b", "B"), ("@c", "c", "C"), ("@d", "d", "D")], "subject_name string, id string, title string")
    got = sorted((r.subject_name, r.from_name, r.to_name) for r in jobs.plan_renames(inv, cur).collect())
    assert got == [("@a", "videoplayback.mp4", "a.mp4"), ("@b", "new.mp4", "b.mp4")]


def test_documents_are_written_without_staging_their_entries_texts(spark, tmp_path, monkeypatch):
    from reelcat.sinks import documents
    from reelcat.sinks.tables import write_manifest_documents

    staged, keep = [], documents.stage_table
    monkeypatch.setattr(documents, "stage_table", lambda df, name: (staged.append(df.columns), keep(df, name))[1])
    fields = "upload_date duration view_count like_count title id webpage_url description".split()
    data = [(f"m{i % 2}", *[None if (i + k) % 5 == 0 else f"{c}{i}" for k, c in enumerate(fields)], "@s") for i in range(8)]
    rows = spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["manifest_name", *fields, "subject_name"]))
    write_manifest_documents(rows, ["a"], str(tmp_path / "out"))
    assert staged and not any("value_json" in columns for columns in staged)
    got = {}
    for m in ("m0", "m1"):
        parts = sorted((tmp_path / "out" / f"manifest_name={m}").glob("part-*"))
        got |= {(m, k): v for k, v in json.loads("".join(p.read_text() for p in parts))["videos"].items()}
    assert got == {(d[0], d[6] or "null"): dict(zip([*fields, "subject_name"], d[1:])) for d in data}


def test_only_rows_of_repeated_keys_are_shuffled_for_the_last_one(spark, monkeypatch):
    from reelcat.operators import dedup

    data = [("a", "x", 1), ("a", "x", 2), ("a", "y", 3), (None, "x", 4), (None, "x", 5), (None, None, 6), (None, None, 7), ("b", None, 8), ("a", "z", None), ("a", "z", 0)]
    df = spark.createDataFrame(data, "f string, id string, pos int")
    want = sorted(map(str, dedup.keep_last(df, ["f", "id"], ["pos"]).collect()))
    got = dedup.keep_last_of_repeated(df, ["f", "id"], ["pos"])
    assert sorted(map(str, got.collect())) == want and "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()
    unique = df.where("pos in (1, 3, 4, 6, 8)")
    plan = (kept := dedup.keep_last_of_repeated(unique, ["f", "id"], ["pos"]))._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 5 and "Exchange" not in plan and "Window" not in plan
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 1)
    assert sorted(map(str, dedup.keep_last_of_repeated(df, ["f", "id"], ["pos"]).collect())) == want
