"""Idempotent ingestion by a log of files, and names reserved by one writer each."""

import os
import random
from concurrent.futures import ThreadPoolExecutor

from reelcat.functions.grammar import RECORD_TERMINATOR as T
from reelcat.operators.dedup import url_index
from reelcat.plans import jobs, latest
from reelcat.sinks import tables as sinks


def dump(folder, name, records):
    (folder / name).write_text("".join(f"| 20240101 | 1 | 2 | 3 | {title} | {i} | https://h.org/{i} | text {T}\n" for i, title in records))


def test_only_new_files_are_ingested(spark, tmp_path):
    d, out = tmp_path / "dumps", str(tmp_path / "videos")
    d.mkdir()
    dump(d, "list_A_x.txt", [("a1", "one"), ("a2", "two")])
    dump(d, "list_B [1]_y z%20.txt", [("b1", "three"), ("a1", "one again")])
    first = jobs.ingest_new(spark, str(d), out)
    assert (first["files"], first["parsed_entries"]) == (2, 4)
    assert jobs.ingest_new(spark, str(d), out) == {"files": 0}
    assert jobs._ingested(spark, out).count() == 4
    dump(d, "list_C_x.txt", [("a2", "two, newer")])
    dump(d, "list_A_x.txt", [("a1", "one"), ("a2", "two"), ("a3", "grown")])  # another length
    more = jobs.ingest_new(spark, str(d), out)
    assert (more["files"], more["parsed_entries"]) == (2, 4)
    got = {r.id: (r.title, r.ingest_run) for r in jobs.committed_videos(spark, out).collect()}
    assert got == {"a1": ("one", 2), "a2": ("two, newer", 2), "a3": ("grown", 2), "b1": ("three", 1)}
    assert {r.ingest_run for r in jobs.ingest_log(spark, out).collect()} == {1, 2}


def test_a_run_that_failed_before_its_log_is_not_seen_and_its_files_come_again(spark, tmp_path, monkeypatch):
    d, out = tmp_path / "dumps", str(tmp_path / "videos")
    d.mkdir()
    dump(d, "list_A_x.txt", [("a1", "one")])
    jobs.ingest_new(spark, str(d), out)
    dump(d, "list_B_x.txt", [("b1", "two")])
    write = sinks.write_videos
    monkeypatch.setattr(sinks, "write_videos", lambda *a, **k: (write(*a, **k), (_ for _ in ()).throw(OSError("lost")))[0])
    try:
        jobs.ingest_new(spark, str(d), out)
        raise AssertionError("the run should have failed")
    except OSError:
        pass
    monkeypatch.setattr(sinks, "write_videos", write)
    assert {r.id for r in jobs.committed_videos(spark, out).collect()} == {"a1"}
    assert jobs.ingest_new(spark, str(d), out)["files"] == 1
    got = {r.id: r.ingest_run for r in jobs.committed_videos(spark, out).collect()}
    assert got == {"a1": 1, "b1": 3}  # the failed run keeps its number


def test_writers_that_ask_at_once_get_different_names(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: sinks.unique_path(spark, str(tmp_path / "out"), "x", ".json"), range(8)))
    assert sorted(os.path.basename(p) for p in got) == ["x.json"] + [f"x_{k}.json" for k in range(2, 9)]
    assert sinks.unique_path(spark, str(tmp_path / "out"), "y").endswith("/y")
    (tmp_path / "out" / "z").mkdir()
    assert sinks.unique_path(spark, str(tmp_path / "out"), "z").endswith("/z_2")


def check_kept(spark, out):
    """Both kept tables against the dedup of every committed row."""
    runs = {r.ingest_run for r in jobs.ingest_log(spark, out).collect()}
    rows = jobs._ingested(spark, out).where(jobs.F.col("ingest_run").isin(list(runs)))
    full = jobs.committed_videos(spark, out)
    assert sorted(map(str, latest.kept_latest(spark, out).select(*full.columns).collect())) == sorted(map(str, full.collect()))
    assert sorted(latest.kept_url_index(spark, out).collect()) == sorted(url_index(rows, jobs.INGEST_ORDER).collect())


def test_the_kept_tables_equal_the_dedup_of_all_runs(spark, tmp_path):
    rng = random.Random(5)
    d, out = tmp_path / "dumps", str(tmp_path / "videos")
    d.mkdir()
    for run in range(5):  # a third of a run's rows share one id
        dump(d, f"list_C{run % 2}_{run}.txt", [("hot" if rng.random() < 0.33 else f"v{rng.randint(0, 30)}", f"t{run}-{i}") for i in range(40)])
        jobs.ingest_new(spark, str(d), out)
        if run != 2:  # two runs in one merge
            assert latest.merge_latest(spark, out, buckets=8)["runs"] == latest.merge_latest(spark, out, "webpage_url", buckets=4)["runs"] == (2 if run == 3 else 1)
    check_kept(spark, out)
    assert latest.merge_latest(spark, out) == {"runs": 0, "buckets": 0}


def test_a_small_run_rewrites_the_buckets_it_touches_and_a_failed_merge_none(spark, tmp_path, monkeypatch):
    d, out = tmp_path / "dumps", str(tmp_path / "videos")
    d.mkdir()
    assert latest.kept_latest(spark, out).count() == 0
    dump(d, "list_A_x.txt", [(f"v{i}", "first") for i in range(60)])
    jobs.ingest_new(spark, str(d), out)
    assert latest.merge_latest(spark, out, buckets=8)["buckets"] == 8
    before = latest.kept.current_version(spark, latest._base(out, "id"))
    dump(d, "list_B_x.txt", [("v7", "second"), ("v7", "third")])
    jobs.ingest_new(spark, str(d), out)
    with monkeypatch.context() as m:
        def lost(*a):  # the buckets are written by then
            raise OSError("lost")

        m.setattr(latest.kept, "commit_version", lost)
        try:
            latest.merge_latest(spark, out)
            raise AssertionError("the merge should have failed")
        except OSError:
            pass
    assert len(os.listdir(f"{out}/_latest/id/data")) == 2  # written, but no version names it
    assert latest.kept.current_version(spark, latest._base(out, "id")) == before
    assert latest.merge_latest(spark, out, buckets=99) == {"runs": 1, "buckets": 1}  # the first merge's buckets stay
    after = latest.kept.current_version(spark, latest._base(out, "id"))
    assert after.buckets == 8 and after.merged == {1, 2} and sum(after.placed[b] != before.placed[b] for b in before.placed) == 1
    latest.merge_latest(spark, out, "webpage_url")
    check_kept(spark, out)
    assert {r.title for r in latest.kept_latest(spark, out).where("id = 'v7'").collect()} == {"third"}


def test_a_merge_stages_no_whole_rows_and_reduces_hot_keys_null_ones_too(spark, tmp_path, monkeypatch):
    d, out = tmp_path / "dumps", str(tmp_path / "videos")
    d.mkdir()
    staged, written, keep, write = [], [], latest.stage_table, latest.kept.write_buckets
    monkeypatch.setattr(latest, "HOT_ROWS", 3, raising=False)
    monkeypatch.setattr(latest, "stage_table", lambda df, name: (staged.append(df.columns), keep(df, name))[1])
    monkeypatch.setattr(latest.kept, "write_buckets", lambda rows, base: (written.append(rows), write(rows, base))[1])
    for run in range(3):
        records = [(f"v{i}", f"t{run}-{i}") for i in range(run, 12)] + [("hot", f"h{run}-{i}") for i in range(6)] + [("few", "x"), ("few", f"y{run}")]
        dump(d, f"list_C{run}_x.txt", records)
        jobs.ingest_new(spark, str(d), out)
        if run == 1:  # null and empty ids, more than HOT_ROWS of them
            rows = jobs._ingested(spark, out).where("ingest_run = 2 and id = 'hot'")
            for k, value in enumerate((None, "")):
                more = rows.withColumn("id", jobs.F.lit(value).cast("string")).withColumn("source_seq", jobs.F.col("source_seq") + 1000 * (k + 1))
                more.localCheckpoint().write.mode("append").partitionBy("youtuber").parquet(out)
        for key in ("id", "webpage_url"):
            latest.merge_latest(spark, out, key, buckets=4)
    check_kept(spark, out)
    assert {(r.id, r.title) for r in latest.kept_latest(spark, out).where("id is null or id in ('', 'hot', 'few')").collect()} == {
        (None, "h1-5"), ("", "h1-5"), ("hot", "h2-5"), ("few", "y2")}
    assert staged and not any("title" in columns or "description" in columns for columns in staged)
    for rows in written:
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(bucket") == 1
