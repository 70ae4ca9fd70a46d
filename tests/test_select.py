"""Selection (F1-F5) and the term-table join (J6), broadcast and gram-index paths."""

import pytest
from pyspark.sql import functions as F

from reelcat.operators.select import select_by_term_table, select_videos

TITLES = ["100% Legs", "100x Legs", "A_B", "AxB", None, "Plain words", "de la mer", "ÉTÉ chaud", "go 😀😀 go"]


@pytest.fixture
def vids(spark):
    data = [(i, t, f"c{i % 2}") for i, t in enumerate(TITLES)]
    return spark.createDataFrame(data, "entry_pos long, title string, youtuber string")


def ids(df):
    return sorted(r["entry_pos"] for r in df.collect())


def test_like_vs_literal(vids):
    assert ids(select_videos(vids, terms=["100%"], match="like")) == [0, 1]
    assert ids(select_videos(vids, terms=["100%"], match="literal")) == [0]
    assert ids(select_videos(vids, terms=["a_b"], match="like")) == [2, 3]
    assert ids(select_videos(vids, terms=["a_b"], match="literal")) == [2]
    assert ids(select_videos(vids, terms=["été"], match="literal")) == [7]


def test_empty_term_and_null_title(vids):
    non_null = [i for i, t in enumerate(TITLES) if t is not None]
    assert ids(select_videos(vids, terms=[""], match="literal")) == non_null
    assert 4 in ids(select_videos(vids))


def test_channel_precedence(vids):
    assert ids(select_videos(vids, channel="c1", terms=["zzz"])) == [1, 3, 5, 7]
    assert ids(select_videos(vids, channel="", terms=["plain"])) == [5]


@pytest.mark.parametrize("match", ["literal", "like"])
def test_term_table_paths_agree_with_brute_force(spark, vids, match):
    terms = ["legs", "a_b", "%", "__________", "de l", "x", "", "zz%zz", "ÉT", "100\\%", "😀 g", "?😀"]
    tdf = spark.createDataFrame([(t,) for t in terms], "term string")
    brute = set()
    for t in terms:
        brute |= set(ids(select_videos(vids, terms=[t], match=match)))
    fast = ids(select_by_term_table(vids, tdf, match=match))
    grams = ids(select_by_term_table(vids, tdf, match=match, max_broadcast_terms=0, anchor=3))
    assert fast == sorted(brute) == grams


def test_channel_filter_reaches_the_stored_tables_scan(spark, tmp_path):
    from reelcat.sinks.tables import write_videos
    from reelcat.sources import derived

    write_videos(derived.videos(spark, "/root/testdata/sf0.001"), str(tmp_path / "videos"))
    v = spark.read.parquet(str(tmp_path / "videos"))
    plan = select_videos(v, channel="src3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(youtuber" in plan and "= src3)" in plan


def test_like_terms_mean_the_same_on_both_paths(spark):
    from reelcat.operators.select import MATCH_LIKE, select_by_term_table

    titles = ["plain words", "50% off", "a_b", "ends with abc%", "back\\slash", "", "axb", None, "long title with 100% of_all things"]
    v = spark.createDataFrame(list(enumerate(titles)), "n int, title string")
    want = {"\\%": {1, 3, 8}, "\\_": {2, 8}, "abc\\": {3}, "a\\_b": {2}, "a_b": {2, 6}, "%": {0, 1, 2, 3, 4, 5, 6, 8}, "": {0, 1, 2, 3, 4, 5, 6, 8},
            "_____": {0, 1, 3, 4, 8}, "\\\\s": {4}, "with 100\\% of\\_all": {8}, "p\\lain": {0}}
    for term, hits in want.items():
        t = spark.createDataFrame([(term,)], "term string")
        for limit in (0, 100):
            got = {r.n for r in select_by_term_table(v, t, MATCH_LIKE, max_broadcast_terms=limit).collect()}
            assert got == hits, (term, limit)


def test_only_titles_without_a_plain_term_meet_the_wildcard_terms(spark, monkeypatch):
    import random

    from reelcat.operators import select as S

    rng, staged, keep = random.Random(3), {}, S.stage_table

    def recorded(df, name):
        staged[name] = keep(df, name)
        return staged[name]

    monkeypatch.setattr(S, "stage_table", recorded)
    words = ["legs", "Leg", "press", "squat", "100%", "a_b", "A\\b", "ends 100%", "İ", "a longer word here", "😀😀"]
    titles = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(60)] + [None]
    v = spark.createDataFrame(list(enumerate(titles)), "entry_pos long, title string")
    terms = ["legs", "LEGS%", "%press", "l_gs", "le%at", "s%s", "100\\", "\\%", "a\\_b", "a_b", "a\\b", "\\\\", "longer word%", "a longer_word", "😀", "%%sq%%"]
    for _ in range(6):
        chosen = rng.sample(terms, rng.randint(1, 5))
        t = spark.createDataFrame([(x,) for x in chosen], "term string")
        staged.clear()
        got = ids(S.select_by_term_table(v, t, "like", max_broadcast_terms=0, anchor=rng.choice([3, 8])))
        assert got == ids(select_videos(v, terms=chosen)), chosen
        plain = [x for x in chosen if x in ("legs", "LEGS%", "%press", "\\%", "a\\_b", "a\\b", "\\\\", "longer word%", "😀", "%%sq%%")]
        if plain and len(plain) < len(chosen):
            met = {titles[i].lower() for i in ids(select_videos(v, terms=plain))}
            assert {r["_lt"] for r in staged["term-join-rest"].collect()} == {x.lower() for x in titles if x is not None} - met
    assert ids(S.select_by_term_table(v, spark.createDataFrame([], "term string"), "like", max_broadcast_terms=-1)) == []
