"""Scalar functions: names (P5-P7, P11-P15), term lists (P10), numbers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelcat.functions import numbers as N
from reelcat.functions import text as T


def ev(spark, expr_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_channel_from_dump_name(spark):
    assert ev(spark, T.channel_from_dump_name, ["list_Chan_Videos.txt", "list__x.txt", "dump.txt"]) == ["Chan", "", None]


def test_catalog_and_subject_names(spark):
    assert ev(spark, T.catalog_name_from_dump, ["list_Chan_Videos.txt"]) == ["_Chan_Videos_VideosObject.json"]
    got = ev(spark, T.subject_from_catalog_name,
             ["/a/b/_Name_x_VideosObject.json", "__x_VideosObject.json", "Plain_VideosObject.json", "_Solo_VideosObject.json"])
    assert got == ["@Name", "@", "Plain", "@Solo"]
    assert ev(spark, T.manifest_name_from_input, ["/p/_A_VideosObject.json"]) == ["_A_VideosObject_matching_Download_ready"]


def test_file_stem_matches_splitext(spark):
    import os

    names = ["a.b.mp4", ".mp4", ".a..mp4", "..mp4", "abc", "a.", "x.MP4"]
    assert ev(spark, T.file_stem, names) == [os.path.splitext(n)[0] for n in names]


def test_url_filename(spark):
    urls = ["https://h.org/a/b.mp4?x=1#f", "http://h.org/", "https://h.org", "https://h.org/a/v;p=1?q"]
    assert ev(spark, T.url_filename, urls) == ["b.mp4", "", "", "v"]


def test_na_fill_subject_media_name(spark):
    assert ev(spark, T.na_fill, [None, "", "x"]) == ["NA", "NA", "x"]
    assert ev(spark, T.subject_from_channel, [None, "c"]) == ["@None", "@c"]
    assert ev(spark, T.media_name, ["v1"]) == ["v1.mp4"]


def test_strip_matches_python(spark):
    vals = ["  x  ", "\t\n y　", "z"]
    assert ev(spark, T.strip_ws, vals) == [v.strip() for v in vals]


@pytest.mark.parametrize("text,expected", [
    ("['a', 'b']", ["a", "b"]), ("[]", [""]), ("[x,  y ]", ["x", "y"]), (None, []),
])
def test_term_list(spark, text, expected):
    assert T.parse_term_list(text) == expected
    if text is not None:
        assert ev(spark, T.parse_term_list_col, [text])[0] == expected


def test_manifest_base_name():
    d = dt.date(2025, 1, 2)
    assert T.manifest_base_name("Chan", ["a"], d) == "videos_Chan_search_20250102_matching_Download_ready"
    assert T.manifest_base_name(None, None, d) == "videos_all_20250102_matching_Download_ready"
    assert T.manifest_base_name("", [], d) == "videos_all_20250102_matching_Download_ready"


def test_tolerant_numbers(spark):
    assert ev(spark, N.tolerant_duration, ["NA", "12d", "nan", None, " 7.5 ", "1e3", "inf", "1_000"]) == [
        None, None, None, 0.0, 7.5, 1000.0, None, None]
    assert ev(spark, lambda c: N.at_least(c, 400), ["400", "399.9", "nan", None, "x"]) == [True, False, False, False, False]
    assert ev(spark, N.status_flag, [None, False, True], "boolean") == [True, False, True]
