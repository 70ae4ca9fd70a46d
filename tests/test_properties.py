"""Property tests: render -> dump -> scan -> parse is the identity (clean mode), in order."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelcat.functions.grammar import RECORD_TERMINATOR as T
from reelcat.operators.dedup import keep_last
from reelcat.operators.parse import classify_entries, parsed_rows
from reelcat.schemas import RECORD_FIELDS
from reelcat.sources.dump import read_dump

WORD = string.ascii_letters + string.digits + "_éüñ"
TEXT = WORD + " .,;:!?'\"-()é"


def field(alphabet, min_size=0, max_size=12):
    # no edge whitespace: the grammar strips it
    return st.text(alphabet, min_size=min_size, max_size=max_size).map(str.strip)


record = st.fixed_dictionaries({
    "upload_date": field(TEXT),
    "duration": field(TEXT),
    "view_count": field(WORD, 1),
    "like_count": field(TEXT),
    # pipes inside titles; pieces non-empty after stripping, so the title has no edge whitespace
    "title": st.lists(field(TEXT, 1).filter(bool), min_size=1, max_size=3).map(" | ".join),
    "id": field(WORD + "-", 1),
    "webpage_url": field(WORD + "/?=&.", 1).map(lambda s: "https://" + s),
    "description": st.lists(field(TEXT + "|", 0, 40), max_size=4).map("\n".join).map(str.strip),
}).filter(lambda r: all(r[k] for k in ("view_count", "id", "title")))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=60))
def test_render_parse_identity(spark, tmp_path_factory, recs):
    d = tmp_path_factory.mktemp("dump")
    text = "".join("\n| " + " | ".join(r[f] for f in RECORD_FIELDS) + f" {T}" for r in recs)
    (d / "list_C_x.txt").write_text(text, encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        out = parsed_rows(classify_entries(read_dump(spark, str(d))))
        got = [tuple(r[f] for f in RECORD_FIELDS)
               for r in out.orderBy("source_file", "source_offset", "source_seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [tuple(r[f] for f in RECORD_FIELDS) for r in recs]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40))
def test_keep_last_is_idempotent_and_last(spark, pairs):
    df = spark.createDataFrame([(k, p, i) for i, (k, p) in enumerate(pairs)], "k int, p int, i int")
    once = keep_last(df, "k", ["p", "i"])
    twice = keep_last(once, "k", ["p", "i"])
    assert sorted(once.collect()) == sorted(twice.collect())
    expect = {}
    for i, (k, p) in enumerate(pairs):
        if k not in expect or (p, i) > expect[k]:
            expect[k] = (p, i)
    assert sorted((r["k"], r["p"], r["i"]) for r in once.collect()) == sorted((k, p, i) for k, (p, i) in expect.items())
