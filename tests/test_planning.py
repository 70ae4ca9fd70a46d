"""Work-list joins (J1, J2, J3), ledger upsert (J4), outcomes (A8), media."""

import random

from pyspark.sql import functions as F

from reelcat.operators import ledger as L
from reelcat.operators import media as M
from reelcat.operators import planning as P
from reelcat.operators.substring import rows_with_contained_needle

MAN = "id string, title string, subject_name string, duration string"
INV = "subject_name string, filename string, quality_dir string, modification_time long"
LED = "subject_name string, video_id string, video_title string, is_link_found boolean, ledger_pos long"


def test_anti_held_keeps_null_ids(spark):
    man = spark.createDataFrame([("a", "t", "@s", "1"), (None, "t2", "@s", "2"), ("b", "t3", "@s", "3")], MAN)
    inv = spark.createDataFrame([("@x", "a.mp4", "HighQuality", 1), ("@x", "b.mp4", None, 2), ("@x", None, "HighQuality", 3)], INV)
    assert sorted(r["title"] for r in P.anti_held(man, inv).collect()) == ["t2", "t3"]


def test_status_lookup_first_row_by_id_and_title(spark):
    man = spark.createDataFrame([("a", "t", "@s", "1"), ("b", "t", "@s", "1"), ("c", "t", "@s", "1")], MAN)
    led = spark.createDataFrame([("@s", "a", "t", False, 1), ("@s", "a", "t", True, 2),
                                 ("@s", "b", "other", False, 3), ("@z", "c", "t", False, 4)], LED)
    got = {r["id"]: r["is_link_found"] for r in P.status_lookup(man, led).collect()}
    assert got == {"a": False, "b": True, "c": True}


def brute_contains(man, files):
    out = set()
    for i, t, s in man:
        for fs, fn in files:
            if fs == s and fn is not None and ((i is not None and i in fn) or (t is not None and t in fn)):
                out.add(i)
    return out


def test_skip_substring_matches_brute_force(spark):
    rnd = random.Random(7)
    alpha = "abc .-"
    man, files = [], []
    for k in range(120):
        s = f"@s{k % 3}"
        title = "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 16)))
        man.append((f"id{k}", title, s))
    for k in range(60):
        s = f"@s{k % 4}"
        name = "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 30))) + (f"id{rnd.randint(0, 130)}" if k % 3 == 0 else "") + ".mp4"
        files.append((s, name))
    m = spark.createDataFrame([(i, t, s, "1") for i, t, s in man], MAN)
    inv = spark.createDataFrame([(s, n, None, 1) for s, n in files], INV)
    for anchor in (4, 12):
        kept = {r["id"] for r in P.skip_substring(m, inv, anchor=anchor).collect()}
        assert kept == {i for i, _, _ in man} - brute_contains(man, files)


def test_empty_title_matches_any_file_of_subject(spark):
    m = spark.createDataFrame([("zz", "", "@s", "1"), ("yy", "", "@t", "1")], MAN)
    inv = spark.createDataFrame([("@s", "q.mp4", None, 1)], INV)
    assert [r["id"] for r in P.skip_substring(m, inv).collect()] == ["yy"]


def test_duration_totals_rollup(spark):
    m = spark.createDataFrame([("a", "t", "@s", "NA"), ("b", "t", "@s", "10"), ("c", "t", "@u", "2.5"),
                               ("d", "t", "@u", "12d")], MAN)
    got = {r["subject_name"]: (r["duration_total"], r["n_videos"]) for r in P.duration_totals(m).collect()}
    assert got == {"@s": (10.0, 2), "@u": (2.5, 2), None: (12.5, 4)}


def test_upsert_updates_in_place_and_appends(spark):
    old = spark.createDataFrame([("@s", "a", "t", True, 1), ("@s", "a", "t-dup", True, 2), ("@s", "b", "t", False, 3)], LED)
    batch = spark.createDataFrame([("@s", "a", "new", False, 10), ("@s", "c", "first", True, 11),
                                   ("@s", "c", "second", False, 12)], LED)
    got = sorted(tuple(r) for r in L.upsert_ledger(old, batch).select(
        "video_id", "video_title", "is_link_found", "ledger_pos").collect())
    assert got == [("a", "new", False, 1), ("a", "new", False, 2), ("b", "t", False, 3), ("c", "second", False, 11)]
    twice = L.upsert_ledger(L.upsert_ledger(old, batch), batch)
    assert sorted(tuple(r) for r in twice.select("video_id", "video_title", "is_link_found", "ledger_pos").collect()) == got


def test_attempt_outcome(spark):
    a = spark.createDataFrame([("v", "x", False, 1), ("v", "y", True, 2), ("w", "x", False, 3)],
                              "video_id string, method string, success boolean, attempt_pos long")
    assert sorted(tuple(r) for r in L.attempt_outcome(a).collect()) == [("v", True, 2), ("w", False, 1)]


def test_latest_media_and_renames(spark):
    inv = spark.createDataFrame([("@s", "old.mp4", None, 1), ("@s", "Title.MP4", None, 5), ("@s", "b.mp4", None, 5),
                                 ("@s", "videoplayback.mp4", None, 0), ("@t", "x.txt", None, 9)], INV)
    latest = M.latest_media(inv)
    assert [tuple(r) for r in latest.collect()] == [("@s", None, "b.mp4", 5)]
    cur = spark.createDataFrame([("@s", "vid", "b.mp4")], "subject_name string, id string, title string")
    from reelcat.plans.jobs import plan_renames

    got = sorted(tuple(r) for r in plan_renames(inv, cur).collect())
    assert got == [("@s", "videoplayback.mp4", "vid.mp4", "default_name")]


def test_skip_substring_hot_subject_with_near_duplicate_series(spark):
    # one subject holds most rows; titles and file names share long prefixes; titles repeat
    man = [(f"id{i}", f"Full Workout Routine Day {i % 150}", "@hot") for i in range(300)]
    man += [(f"x{i}", f"Other {i}", f"@s{i % 3}") for i in range(30)]
    files = [("@hot", f"Full Workout Routine Day {i} (final cut).mp4") for i in range(0, 150, 2)]
    files += [("@s1", "Other 4.mp4"), ("@hot", "id299.mp4")]
    m = spark.createDataFrame([(i, t, s, "1") for i, t, s in man], MAN)
    inv = spark.createDataFrame([(s, n, None, 1) for s, n in files], INV)
    kept = {r["id"] for r in P.skip_substring(m, inv).collect()}
    assert kept == {i for i, _, _ in man} - brute_contains(man, files)


def test_grams_are_code_points_even_for_surrogate_pairs(spark):
    from reelcat.operators.substring import chunks_of, grams_of

    df = spark.createDataFrame([("a😀bc",), ("😀😀",)], "s string")
    got = [r[0] for r in df.select(grams_of(F.col("s"), 2)).collect()]
    assert got == [["a😀", "😀b", "bc"], ["😀😀"]]
    ch = [r[0] for r in df.select(chunks_of(F.col("s"), 2)).collect()]
    assert ch == [["a😀", "bc"], ["😀😀"]]


def test_skip_substring_with_emoji_names(spark):
    man = [("e1", "Leg 😀 day", "@s"), ("e2", "😀", "@s"), ("e3", "no match here at all", "@s"), ("e4", "x😀y", "@s")]
    files = [("@s", "best Leg 😀 day ever.mp4"), ("@s", "plain.mp4"), ("@s", "x😀y.mp4")]
    m = spark.createDataFrame([(i, t, s, "1") for i, t, s in man], MAN)
    inv = spark.createDataFrame([(s, n, None, 1) for s, n in files], INV)
    for anchor in (3, 12):
        kept = {r["id"] for r in P.skip_substring(m, inv, anchor=anchor).collect()}
        assert kept == {i for i, _, _ in man} - brute_contains(man, files)
