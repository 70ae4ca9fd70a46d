"""Views of the media-catalog data model derived from the given tables.

The given tables are generic (documents, pages, events); these views give them
the shapes the catalog operators work on, by fixed arithmetic rules, so that
every case an operator must handle occurs and every view grows with the data:

* ``videos``       one row per document: duplicate ids across channels, ``NA``,
                   null and empty values, 20 channels, multi-language titles
* ``inventory``    media files held per subject, named by id or by title,
                   in the ``HighQuality`` folder or flat in the subject folder
* ``link_status``  an existing status ledger
* ``new_status``   a later status batch: some keys old, some new, titles changed
* ``attempts``     download attempts per video (from ``events``)
* ``result_pages`` the crawled pages with the blocks of a result page put into their bodies

``videos(..., hot=True)`` gives one channel a third of all rows and
``videos(..., hot_id=True)`` one id a third of all rows (skew checks);
``inventory`` and ``link_status`` follow ``hot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.functions.grammar import render_record
from reelcat.functions.text import media_name, subject_from_channel
from reelcat.schemas import RECORD_FIELDS
from reelcat.session import spread, staging_path
from reelcat.sinks.dump import write_dump
from reelcat.sources.tables import table


def _mod(c: Column, n: int) -> Column:
    return c % F.lit(n)


HOT_CHANNEL = "src0"


HOT_ID_KEY = 0


def videos(spark: SparkSession, sf_dir: str, hot: bool = False, hot_id: bool = False) -> DataFrame:
    """``hot=True``: one channel (``src0``) holds every third video, a third of all rows.
    ``hot_id=True``: every third video repeats one id (``v0``), a third of all rows."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    # every tenth document repeats the previous id under another channel
    key = F.when(_mod(doc, 10) == 9, doc - 1).otherwise(doc)
    if hot_id:
        key = F.when(_mod(doc, 3) == 0, F.lit(HOT_ID_KEY)).otherwise(key)
    key = key.cast("string")
    # two ids share a URL, and the repeated ids have two
    url = F.when(_mod(doc, 10) == 7, doc - 1).otherwise(doc).cast("string")
    # text before the first '.', as split_part(text, '.', 1), without splitting the whole text
    title = F.replace(F.substring_index(F.col("text"), ".", 1), F.lit("\n"), F.lit(" "))
    return d.select(
        doc.alias("entry_pos"),
        F.concat(
            F.lit("2024"),
            F.lpad((1 + _mod(doc, 12)).cast("string"), 2, "0"),
            F.lpad((1 + _mod(doc, 28)).cast("string"), 2, "0"),
        ).alias("upload_date"),
        F.when(_mod(doc, 17) == 0, F.lit("NA"))
        .when(_mod(doc, 19) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("n_chars").cast("string"))
        .alias("duration"),
        (F.col("n_chars") * 7).cast("string").alias("view_count"),
        F.when(_mod(doc, 5) == 0, F.lit("")).otherwise(_mod(F.col("n_chars"), 101).cast("string")).alias("like_count"),
        F.when(_mod(doc, 43) == 6, F.lit("")).when(_mod(doc, 37) == 2, F.concat(F.lit('"q" '), title, F.lit(", 100%")))
        .when(_mod(doc, 47) == 3, F.concat(F.lit("a_b "), title)).otherwise(title).alias("title"),
        F.concat(F.lit("v"), key).alias("id"),
        F.concat(F.lit("https://media.example.org/watch?v=v"), url).alias("webpage_url"),
        F.when(_mod(doc, 23) == 0, F.lit(None).cast("string"))
        .when(_mod(doc, 29) == 4, F.concat(F.col("text"), F.lit(" see a_/b"))).otherwise(F.col("text")).alias("description"),
        (F.when(_mod(doc, 3) == 0, F.lit(HOT_CHANNEL)).otherwise(F.col("source")) if hot
         else F.when(_mod(doc, 41) != 5, F.col("source"))).alias("youtuber"),
    )


def inventory(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Held media: ``<base>/<subject>/[HighQuality/]<name>.mp4`` as rows."""
    v = videos(spark, sf_dir, hot).where(_mod(F.col("entry_pos"), 3) == 0)
    pos = F.col("entry_pos")
    return v.select(
        subject_from_channel("youtuber").alias("subject_name"),
        F.when(_mod(pos, 21) == 0, F.lit("videoplayback.mp4")).when(_mod(pos, 33) == 12, F.concat("id", F.lit(".webm")))
        .when(_mod(pos, 39) == 9, F.concat("id", F.lit(".MP4"))).when(_mod(pos, 27) == 15, F.concat("id", F.lit(".cut.mp4")))
        .when(_mod(pos, 2) == 0, media_name("id")).otherwise(media_name("title")).alias("filename"),
        F.when(_mod(pos, 9) < 5, F.lit("HighQuality")).alias("quality_dir"),
        F.floor(pos / 40).alias("modification_time"),
        pos.alias("list_pos"),
    )


def link_status(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Every fifth key is there twice, the later row with the other status."""
    v = videos(spark, sf_dir, hot).where(_mod(F.col("entry_pos"), 5) < 2)
    v = v.withColumn("again", F.explode(F.when(_mod(F.col("entry_pos"), 5) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return v.select(
        subject_from_channel("youtuber").alias("subject_name"),
        F.col("id").alias("video_id"),
        F.col("title").alias("video_title"),
        ((_mod(F.col("entry_pos"), 7) != 0) != (F.col("again") == 1)).alias("is_link_found"),
        (F.col("entry_pos") + F.col("again") * 10_000_000).alias("ledger_pos"),
    )


def new_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second key is there twice, with another title and status."""
    v = videos(spark, sf_dir).where(_mod(F.col("entry_pos"), 4) == 0)
    v = v.withColumn("again", F.explode(F.when(_mod(F.col("entry_pos"), 8) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return v.select(
        subject_from_channel("youtuber").alias("subject_name"),
        F.col("id").alias("video_id"),
        F.concat(F.col("title"), F.lit(" v"), (2 + F.col("again")).cast("string")).alias("video_title"),
        ((_mod(F.col("entry_pos"), 3) == 0) != (F.col("again") == 1)).alias("is_link_found"),
        (F.col("entry_pos") + 100_000_000 + F.col("again") * 10_000_000).alias("ledger_pos"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download attempts: user as video, event type as method, purchase as success."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video_id"),
        F.col("event_type").alias("method"),
        (F.col("event_type") == F.lit("purchase")).alias("success"),
        F.col("event_id").alias("attempt_pos"),
    )


# A result page's blocks as one SQL expression that means the same to Spark and DuckDB (no
# backslashes, quotes inside texts as Q): nested elements of one name before and inside the
# ones looked for, decoys (comments, scripts, like names), and every shape of link and label.
_K = "cast(page_id AS varchar(20))"
_HREF_SHAPES = [f"'https://cdn.example.net/f/' || {_K} || '.mp4'", f"'/get/' || {_K} || '?x=1&amp;y=2'", f"'../up/' || {_K} || '.mp4'", f"'?page=' || {_K}",
                f"'//cdn.example.net/' || {_K}", f"'./a/./b/../' || {_K} || '#f'"]
_LABEL_SHAPES = [f"cast(page_id % 900 AS varchar(20))", "'HD'", "'720.5'", "''", "'39<i>9</i>'"]


def _case(modulus: int, shapes: list[str]) -> str:
    return f"CASE page_id % {modulus} " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(shapes)) + " END"


def _group(k: int) -> str:
    return (f"CASE WHEN page_id % 4 > {k} THEN '<div><div class=\"g link-group\"><div><p>text</p></div><div><a class=\"b\" href=\"/g{k}/' || {_K}"
            f" || '\">go</a></div></div></div>' ELSE '<div class=\"link-groups\"><a href=\"/no\">no</a></div>' END")


RESULT_BLOCK_SQL = " || ".join([
    "'<div id=\"other\"><div class=\"def-btn-box\"><a href=\"/decoy\">d</a></div></div><!-- <div id=\"sf_result\"> -->'",
    "CASE WHEN page_id % 11 = 0 THEN '' ELSE '<DIV data-note=\"a > b\" id=\"sf_result\"><script>var x=\"</div></div>\";</script><div><div>n</div></div>"
    "<div class=\"def-btn-boxes\"><a href=\"/like\">l</a></div><div class=' || chr(39) || 'x def-btn-box y' || chr(39) || '><div class=\"in\"><p>no link</p></div></div>"
    "<div class=\"def-btn-box\"><div><br><img src=\"/i.png\"></div><a name=\"n\">none</a><a class=b href=' || chr(39) || (" + _case(6, _HREF_SHAPES) + ") || chr(39) || '>go</a></div>"
    "<div class=\"def-btn-name\"><div>q</div><span> <b>' || (" + _case(5, _LABEL_SHAPES) + ") || '</b> </span><span>1080</span></div></DIV>' END",
    "'<div class=\"def-btn-box\"><a href=\"/late\">z</a></div><div id=\"links\"><div class=\"main\"><div><a href=\"/top\">t</a></div>'", _group(0), _group(1), _group(2), "'</div></div>'",
    "'<section id=\"landingTz-main-screen-top\"><a class=\"landingTz-btn-close\" href=\"/hd\">high quality</a><a class=\"landingTz-btn-close'",
    "CASE WHEN page_id % 10 = 3 THEN ' big' ELSE '' END", f"'\" href=\"/lq/' || {_K} || '.mp4?a=1&amp;b=&#50;\"><i>get it</i> with low quality</a></section>'",
    "CASE page_id % 9 WHEN 4 THEN '<div class=\"note result-failure-box\"><div>Sorry.</div> The download link not found.</div>'"
    " WHEN 5 THEN '<div class=\"result-failure\"><div>The down<b>load</b></div> link not found.</div>'"
    " WHEN 6 THEN '<div class=\"result-failure\"><div>x</div></div><div>The download link not found.</div>' ELSE '' END",
    "'<div id=\"c-ui-popup\"><div><div>t</div></div><p>'", "CASE WHEN page_id % 6 = 2 THEN 'Unable <b>to</b> download' ELSE 'Ready' END", "'</p></div>'",
])
RESULT_PAGES_SQL = f"SELECT page_id, url, replace(html, '<body>', '<body>' || {RESULT_BLOCK_SQL}) AS html FROM pages"


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): result pages made from the crawled ones by ``RESULT_BLOCK_SQL``."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.replace("html", F.lit("<body>"), F.concat(F.lit("<body>"), F.expr(RESULT_BLOCK_SQL))).alias("html"))


# ------------------------------------------------------------- SQL (oracle)
# The same views as DuckDB SQL, used as CTEs by the oracle queries.

VIDEOS_SQL = """SELECT doc_id AS entry_pos,
 concat('2024', lpad(cast(1 + doc_id % 12 AS varchar), 2, '0'), lpad(cast(1 + doc_id % 28 AS varchar), 2, '0')) AS upload_date,
 CASE WHEN doc_id % 17 = 0 THEN 'NA' WHEN doc_id % 19 = 0 THEN NULL ELSE cast(n_chars AS varchar) END AS duration,
 cast(n_chars * 7 AS varchar) AS view_count,
 CASE WHEN doc_id % 5 = 0 THEN '' ELSE cast(n_chars % 101 AS varchar) END AS like_count,
 CASE WHEN doc_id % 43 = 6 THEN '' WHEN doc_id % 37 = 2 THEN '"q" ' || replace(split_part(text, '.', 1), chr(10), ' ') || ', 100%'
  WHEN doc_id % 47 = 3 THEN 'a_b ' || replace(split_part(text, '.', 1), chr(10), ' ')
  ELSE replace(split_part(text, '.', 1), chr(10), ' ') END AS title,
 concat('v', cast(CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END AS varchar)) AS id,
 concat('https://media.example.org/watch?v=v', cast(CASE WHEN doc_id % 10 = 7 THEN doc_id - 1 ELSE doc_id END AS varchar)) AS webpage_url,
 CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 4 THEN text || ' see a_/b' ELSE text END AS description,
 CASE WHEN doc_id % 41 <> 5 THEN source END AS youtuber
FROM documents"""

INVENTORY_SQL = """SELECT concat('@', coalesce(youtuber, 'None')) AS subject_name,
 CASE WHEN entry_pos % 21 = 0 THEN 'videoplayback.mp4' WHEN entry_pos % 33 = 12 THEN concat(id, '.webm')
  WHEN entry_pos % 39 = 9 THEN concat(id, '.MP4') WHEN entry_pos % 27 = 15 THEN concat(id, '.cut.mp4')
  WHEN entry_pos % 2 = 0 THEN concat(id, '.mp4') ELSE concat(title, '.mp4') END AS filename,
 CASE WHEN entry_pos % 9 < 5 THEN 'HighQuality' END AS quality_dir,
 entry_pos // 40 AS modification_time, entry_pos AS list_pos
FROM videos WHERE entry_pos % 3 = 0"""

LINK_STATUS_SQL = """SELECT concat('@', coalesce(youtuber, 'None')) AS subject_name, id AS video_id, title AS video_title,
 (entry_pos % 7 <> 0) <> (again = 1) AS is_link_found, entry_pos + again * 10000000 AS ledger_pos
FROM videos, (VALUES (0), (1)) AS a(again) WHERE entry_pos % 5 < 2 AND (again = 0 OR entry_pos % 5 = 0)"""

NEW_STATUS_SQL = """SELECT concat('@', coalesce(youtuber, 'None')) AS subject_name, id AS video_id, concat(title, ' v', 2 + again) AS video_title,
 (entry_pos % 3 = 0) <> (again = 1) AS is_link_found, entry_pos + 100000000 + again * 10000000 AS ledger_pos
FROM videos, (VALUES (0), (1)) AS a(again) WHERE entry_pos % 4 = 0 AND (again = 0 OR entry_pos % 8 = 0)"""

ATTEMPTS_SQL = """SELECT concat('v', cast(user_id AS varchar)) AS video_id, event_type AS method,
 (event_type = 'purchase') AS success, event_id AS attempt_pos
FROM events"""


def with_views(body: str, *names: str, extra: dict[str, str] | None = None, hot: bool = False,
               hot_id: bool = False) -> str:
    """Prefix ``body`` with the named views as CTEs (dependencies first), then ``extra``."""
    videos_sql = VIDEOS_SQL
    if hot_id:
        videos_sql = videos_sql.replace(
            "CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END",
            f"CASE WHEN doc_id % 3 = 0 THEN {HOT_ID_KEY} WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END")
    if hot:
        videos_sql = videos_sql.replace(
            " CASE WHEN doc_id % 41 <> 5 THEN source END AS youtuber", f" CASE WHEN doc_id % 3 = 0 THEN '{HOT_CHANNEL}' ELSE source END AS youtuber")
    sql = {
        "videos": videos_sql,
        "inventory": INVENTORY_SQL,
        "link_status": LINK_STATUS_SQL,
        "new_status": NEW_STATUS_SQL,
        "attempts": ATTEMPTS_SQL,
    }
    needed = list(names)
    if any(n in ("inventory", "link_status", "new_status") for n in needed) and "videos" not in needed:
        needed.insert(0, "videos")
    order = ["videos", "inventory", "link_status", "new_status", "attempts"]
    parts = [(n, sql[n]) for n in order if n in needed] + list((extra or {}).items())
    ctes = ",\n".join(f"{n} AS (\n{q}\n)" for n, q in parts)
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------- dump fixture
# A dump rendered from ``videos``: every 13th record (pos % 13 = 5) gets text
# before its first pipe, so it must be rejected; after every 50th record
# (pos % 50 = 7) comes a blank entry, which must be skipped and counted; after every
# 31st (pos % 31 = 3) an id and a URL in the wrong place and then only words, which
# must be rejected, and in time linear in its length.
MALFORMED = "| a | id1 | https://media.example.org/v" + " | word" * 60


def dump_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos(spark, sf_dir)
    pos = F.col("entry_pos")
    junk = F.when(_mod(pos, 13) == 5, F.lit("junk ")).otherwise(F.lit(""))
    records = v.select(
        "youtuber", pos.alias("k1"), F.lit(0).alias("k2"),
        F.concat(F.lit("\n"), junk, render_record(*RECORD_FIELDS)).alias("value"),
    )
    blanks = v.where(_mod(pos, 50) == 7).select(
        "youtuber", pos.alias("k1"), F.lit(1).alias("k2"), F.lit("\n  ").alias("value"))
    broken = v.where(_mod(pos, 31) == 3).select(
        "youtuber", pos.alias("k1"), F.lit(2).alias("k2"), F.lit("\n" + MALFORMED + " ").alias("value"))
    return records.unionByName(blanks).unionByName(broken)


_STAGED: dict[tuple[str, str, str], str] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def staged_once(spark: SparkSession, kind: str, sf_dir: str, build) -> str:
    """Path of a derived input written once per application and ``sf_dir``.

    Derived inputs (a rendered dump, built catalogs) are deterministic functions
    of the given tables; ``build(path)`` writes one under the shared staging folder.
    """
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    path = _STAGED.get(key)
    if path is None or not _exists(spark, path):
        path = staging_path(spark, kind)
        build(path)
        _STAGED[key] = path
    return path


def staged_dump(spark: SparkSession, sf_dir: str) -> str:
    """The dump fixture under the shared staging folder, one folder per channel."""
    return staged_once(spark, "dump", sf_dir, lambda path: write_dump(
        dump_fixture(spark, sf_dir), path, order_by=["k1", "k2"], partition_by=["youtuber"]))


DUMP_RENDER_SQL = (
    "'| ' || concat_ws(' | ', coalesce(upload_date, ''), coalesce(duration, ''), coalesce(view_count, ''),"
    " coalesce(like_count, ''), coalesce(title, ''), coalesce(id, ''), coalesce(webpage_url, ''),"
    " coalesce(description, '')) || ' '"
)
