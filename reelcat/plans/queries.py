"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (through the views of ``sources.derived``),
so its work grows with them. ``ORACLES`` holds the equivalent DuckDB SQL for
each query, written next to it; column names match exactly.

Sections: dump scan and parse (S1, P1, F6, F7, A3), dedup (A1, A2), selection
(F1-F5, J6), manifests (C3, A4, A11, K3), catalogs (C2, C4), the work list
(J1-J3, C5, A5, A6, T1), the ledger (J4, C6, A7, A8), media (A9, A10, C7),
pages (C8, X1-X5, F9, F12, P13) and file names (P5-P7, P12). The ``*_hot_*``
queries rerun a plan with one subject or one id holding a third of all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.functions import text as T
from reelcat.functions.text import subject_from_channel
from reelcat.operators import ledger as ledger_ops
from reelcat.operators import manifest as manifest_ops
from reelcat.operators import media as media_ops
from reelcat.operators import pages as page_ops
from reelcat.operators import parse as parse_ops
from reelcat.operators import planning
from reelcat.plans import jobs
from reelcat.operators.dedup import dedup_videos, keep_last, keep_last_of_repeated, url_index
from reelcat.operators.select import MATCH_LIKE, MATCH_LITERAL, select_by_term_table, select_videos
from reelcat.schemas import RECORD_FIELDS
from reelcat.session import spread, staging_path
from reelcat.sinks.tables import manifest_header_json, write_catalog_rows, write_manifest_documents
from reelcat.sources.files import read_catalog_rows
from reelcat.sources.tables import table
from reelcat.sources import derived
from reelcat.sources.derived import DUMP_RENDER_SQL, with_views
from reelcat.sources.dump import read_dump

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"

# ------------------------------------------------------------------ S1 / P1


def _classified_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derived.staged_dump(spark, sf_dir)
    return parse_ops.classify_entries(read_dump(spark, path), channel_from_name=False)


@register(
    "parse_dump",
    with_views(
        "SELECT "
        + ", ".join(f"{_STRIP.format(f'coalesce({c}, {chr(39)}{chr(39)})')} AS {c}" for c in RECORD_FIELDS)
        + " FROM videos WHERE entry_pos % 13 <> 5",
        "videos",
    ),
)
def q_parse_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> F7 -> P1 -> F6: the records of a dump, whole fields, in any order."""
    return parse_ops.parsed_rows(_classified_dump(spark, sf_dir)).select(*RECORD_FIELDS)


@register(
    "parse_dump_compat",
    with_views(
        "SELECT "
        + ", ".join(f"{_STRIP.format(f'coalesce({c}, {chr(39)}{chr(39)})')} AS {c}" for c in RECORD_FIELDS[:-1])
        + ", CASE WHEN coalesce(description, '') = '' THEN '\\' ELSE regexp_replace(split_part(description || ' \\_/', '_/', 1), '\\s+$', '') END AS description"
        + " FROM videos WHERE entry_pos % 13 <> 5",
        "videos",
    ),
)
def q_parse_dump_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 in literal mode: the description keeps the producer's trailing `` \\`` (cut at the first ``_/``)."""
    path = derived.staged_dump(spark, sf_dir)
    cls = parse_ops.classify_entries(read_dump(spark, path), compat=True, channel_from_name=False)
    return parse_ops.parsed_rows(cls).select(*RECORD_FIELDS)


@register(
    "parse_rejects",
    with_views(
        f"SELECT {_STRIP.format(chr(39) + 'junk ' + chr(39) + ' || ' + DUMP_RENDER_SQL)} AS entry, 'rejected' AS reason"
        f" FROM videos WHERE entry_pos % 13 = 5 UNION ALL SELECT '{derived.MALFORMED}', 'rejected' FROM videos WHERE entry_pos % 31 = 3",
        "videos",
    ),
)
def q_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entries that do not fit the grammar, kept with the reason."""
    return parse_ops.rejected_rows(_classified_dump(spark, sf_dir)).select("entry", "reason")


@register(
    "load_metrics",
    with_views(
        f"""SELECT
 CAST(sum(CASE WHEN entry_pos % 13 = 5 THEN 6 ELSE 1 END + length({DUMP_RENDER_SQL}))
   + 3 * count(*) FILTER (WHERE entry_pos % 50 = 7) + {len(derived.MALFORMED) + 2} * count(*) FILTER (WHERE entry_pos % 31 = 3) AS BIGINT) AS chars,
 count(*) + count(*) FILTER (WHERE entry_pos % 50 = 7) + count(*) FILTER (WHERE entry_pos % 31 = 3) AS entries,
 count(*) FILTER (WHERE entry_pos % 50 = 7) AS empty_entries,
 count(*) FILTER (WHERE entry_pos % 13 <> 5) AS parsed_entries,
 count(*) FILTER (WHERE entry_pos % 13 = 5) + count(*) FILTER (WHERE entry_pos % 31 = 3) AS rejected_entries,
 count(DISTINCT id) FILTER (WHERE entry_pos % 13 <> 5) AS distinct_ids,
 count(DISTINCT webpage_url) FILTER (WHERE entry_pos % 13 <> 5) AS distinct_urls
FROM videos""",
        "videos",
    ),
)
def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: load counters of a dump, computed in one distributed aggregate."""
    return parse_ops.load_metrics(_classified_dump(spark, sf_dir))


# ------------------------------------------------------------------ shared SQL pieces


def _sql(s: str) -> str:
    """A DuckDB string literal (no backslash processing; quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"


_DEDUP_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY entry_pos DESC) AS _rn FROM {src}) WHERE _rn = 1"
_NA = "coalesce(nullif({0}, ''), 'NA') AS {0}"
_MANIFEST_COLS = (
    ", ".join(_NA.format(c) if c not in ("title", "id") else c for c in RECORD_FIELDS)
    + ", concat('@', coalesce(youtuber, 'None')) AS subject_name"
)


def _manifest_ctes(where: str = "TRUE") -> dict[str, str]:
    """Oracle CTEs: ``selected`` videos, then the ``manifest`` rows (A1 + P3 + P4)."""
    return {
        "selected": f"SELECT * FROM videos WHERE {where}",
        "manifest": f"SELECT entry_pos, {_MANIFEST_COLS} FROM ({_DEDUP_SQL.format(src='selected')})",
    }


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All videos as one manifest (no selection): A1 -> P3 -> P4."""
    return manifest_ops.manifest_rows(derived.videos(spark, sf_dir))



# ------------------------------------------------------------------ A1, A2 / J5

_VIDEO_OUT = ["entry_pos", *RECORD_FIELDS, "youtuber"]


@register("dedup_last_wins", with_views(_DEDUP_SQL.format(src="videos").replace("SELECT *", "SELECT " + ", ".join(_VIDEO_OUT), 1), "videos"))
def q_dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: one row per id, the last entry wins."""
    return dedup_videos(derived.videos(spark, sf_dir)).select(*_VIDEO_OUT)


@register("dedup_hot_id", with_views(_DEDUP_SQL.format(src="videos").replace("SELECT *", "SELECT " + ", ".join(_VIDEO_OUT), 1),
                                    "videos", hot_id=True))
def q_dedup_hot_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 when one id repeats across a third of all rows (partial WindowGroupLimit before the shuffle)."""
    return dedup_videos(derived.videos(spark, sf_dir, hot_id=True)).select(*_VIDEO_OUT)


@register(
    "url_index",
    with_views(
        "SELECT webpage_url, id FROM (SELECT *, row_number() OVER (PARTITION BY webpage_url ORDER BY entry_pos DESC) AS _rn"
        " FROM videos) WHERE _rn = 1",
        "videos",
    ),
)
def q_url_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL -> id, the last entry per URL wins."""
    return url_index(derived.videos(spark, sf_dir))


# ------------------------------------------------------------------ F1-F5, J6

SELECT_CHANNEL = "src3"
SELECT_TERMS = ["und", "de_l", "ou%re", "100%"]
_SEL_OUT = ["entry_pos", "id", "title", "youtuber"]
_SEL_SQL = "SELECT entry_pos, id, title, youtuber FROM videos WHERE "


def _like_sql(terms: list[str]) -> str:
    return " OR ".join(f"lower(title) LIKE lower('%' || {_sql(t)} || '%') ESCAPE '\\'" for t in terms)


def _literal_sql(terms: list[str]) -> str:
    return " OR ".join(f"contains(lower(title), lower({_sql(t)}))" for t in terms)


@register("select_channel", with_views(_SEL_SQL + f"youtuber = {_sql(SELECT_CHANNEL)}", "videos"))
def q_select_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one channel (pushed into the Parquet scan as EqualTo)."""
    return select_videos(derived.videos(spark, sf_dir), channel=SELECT_CHANNEL).select(*_SEL_OUT)


@register("select_like", with_views(_SEL_SQL + _like_sql(SELECT_TERMS), "videos"))
def q_select_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """any term, case-insensitive LIKE (``%`` and ``_`` are wildcards)."""
    return select_videos(derived.videos(spark, sf_dir), terms=SELECT_TERMS, match=MATCH_LIKE).select(*_SEL_OUT)


@register("select_literal", with_views(_SEL_SQL + _literal_sql(SELECT_TERMS), "videos"))
def q_select_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """any term, case-insensitive literal substring."""
    return select_videos(derived.videos(spark, sf_dir), terms=SELECT_TERMS, match=MATCH_LITERAL).select(*_SEL_OUT)


@register("select_all", with_views(_SEL_SQL + "TRUE", "videos"))
def q_select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """no channel and no terms keeps every row (an empty channel counts as none)."""
    return select_videos(derived.videos(spark, sf_dir), channel="", terms=[]).select(*_SEL_OUT)


@register("select_precedence", with_views(_SEL_SQL + f"youtuber = {_sql('src5')}", "videos"))
def q_select_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a channel wins over terms."""
    return select_videos(derived.videos(spark, sf_dir), channel="src5", terms=["zzzz"]).select(*_SEL_OUT)


def _bench_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms derived from the data: every word of every benchmark passage."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.explode(F.split(F.lower("text"), " ")).alias("term")).where(F.length("term") >= 3).distinct()


_TERMS_SQL = "SELECT DISTINCT term FROM (SELECT unnest(string_split(lower(text), ' ')) AS term FROM benchmark) WHERE length(term) >= 3"
_TERM_JOIN_SQL = with_views(
    "SELECT entry_pos, id, title, youtuber FROM videos v WHERE EXISTS "
    "(SELECT 1 FROM terms t WHERE contains(lower(v.title), lower(t.term)))",
    "videos", extra={"terms": _TERMS_SQL},
)


@register("select_terms_join", _TERM_JOIN_SQL)
def q_select_terms_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms as a table, size-checked broadcast semi join."""
    return select_by_term_table(derived.videos(spark, sf_dir), _bench_terms(spark, sf_dir)).select(*_SEL_OUT)


@register("select_terms_index", _TERM_JOIN_SQL)
def q_select_terms_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 beyond the broadcast limit: the exact gram-index join (forced here)."""
    return select_by_term_table(derived.videos(spark, sf_dir), _bench_terms(spark, sf_dir),
                                max_broadcast_terms=0).select(*_SEL_OUT)


# ------------------------------------------------------------------ C3: manifests

MANIFEST_TERMS = ["the", "de_l"]
_MANIFEST_OUT = [*RECORD_FIELDS, "subject_name"]


@register(
    "manifest_rows",
    with_views("SELECT " + ", ".join(_MANIFEST_OUT) + " FROM manifest", "videos",
               extra=_manifest_ctes(_like_sql(MANIFEST_TERMS))),
)
def q_manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 selection -> A1 -> P3 (NA) -> P4 (@channel)."""
    return manifest_ops.select_manifest(derived.videos(spark, sf_dir), terms=MANIFEST_TERMS).select(*_MANIFEST_OUT)


@register(
    "manifest_summary",
    with_views(
        "SELECT subject_name, count(DISTINCT id) AS n_videos, "
        + _sql('"search_terms": ["the", "de_l"],')
        + " AS header_json FROM manifest GROUP BY subject_name",
        "videos", extra=_manifest_ctes(_like_sql(MANIFEST_TERMS)),
    ),
)
def q_manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A11: videos per subject of a manifest, with the manifest header."""
    rows = manifest_ops.select_manifest(derived.videos(spark, sf_dir), terms=MANIFEST_TERMS)
    return (manifest_ops.manifest_summary(rows, MANIFEST_TERMS).drop("search_terms")
            .withColumn("header_json", F.lit(manifest_header_json(MANIFEST_TERMS))))


@register(
    "manifest_envelope",
    with_views(
        "SELECT subject_name || '_matching_Download_ready' AS manifest_name, count(DISTINCT id) AS n_keys,"
        " count(DISTINCT id) + 5 AS n_lines FROM manifest GROUP BY subject_name",
        "videos", extra=_manifest_ctes(_like_sql(MANIFEST_TERMS)),
    ),
)
def q_manifest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: manifest documents per subject written as sorted lines, read back and counted.

    Each entry is one line (``to_json`` escapes newlines); a document has its
    entries plus five frame lines (``{``, header, section open/close, ``}``).
    """
    rows = manifest_ops.select_manifest(derived.videos(spark, sf_dir), terms=MANIFEST_TERMS)
    rows = rows.withColumn("manifest_name", F.concat("subject_name", F.lit("_matching_Download_ready")))
    path = staging_path(spark, "manifests")
    write_manifest_documents(rows, MANIFEST_TERMS, path)
    lines = spark.read.text(path)
    return lines.groupBy("manifest_name").agg(
        F.count_if(F.col("value").rlike('^(    |  , )"')).alias("n_keys"), F.count(F.lit(1)).alias("n_lines"))


# ------------------------------------------------------------------ C2 / C4: catalogs

CATALOG_TERMS = ["the", "und"]
# the catalog a video lands in, by a rule on its upload month (month - 1) % 3 = doc % 3
_CATALOG_FILE_SQL = (
    "CASE entry_pos % 3 WHEN 0 THEN '_' || youtuber || '_Videos_VideosObject.json'"
    " WHEN 1 THEN '_' || youtuber || '_VideosObject.json' ELSE youtuber || '_Shorts_VideosObject.json' END"
)


def _catalog_file() -> "F.Column":
    p = (F.substring("upload_date", 5, 2).try_cast("int") - 1) % 3
    return (F.when(p == 0, F.concat(F.lit("_"), "youtuber", F.lit("_Videos_VideosObject.json")))
            .when(p == 1, F.concat(F.lit("_"), "youtuber", F.lit("_VideosObject.json")))
            .otherwise(F.concat("youtuber", F.lit("_Shorts_VideosObject.json"))))


def _catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 core: dump -> parse -> one row per (catalog, id), the last entry wins."""
    parsed = parse_ops.parsed_rows(_classified_dump(spark, sf_dir))
    rows = parsed.withColumn("catalog_file", _catalog_file())
    return keep_last_of_repeated(rows, ["catalog_file", "id"], ["source_file", "source_offset", "source_seq"])


def _write_catalogs(spark: SparkSession, sf_dir: str, path: str) -> None:
    write_catalog_rows(_catalog_rows(spark, sf_dir), path)


def _staged_catalogs(spark: SparkSession, sf_dir: str) -> str:
    """Catalogs built once per application (C4's input)."""
    return derived.staged_once(spark, "catalogs", sf_dir, lambda path: _write_catalogs(spark, sf_dir, path))


_CATALOG_ROWS_SQL = (
    "SELECT catalog_file, id, coalesce(title, '') AS title, coalesce(duration, '') AS duration FROM ("
    "SELECT *, row_number() OVER (PARTITION BY catalog_file, id ORDER BY entry_pos DESC) AS _rn"
    f" FROM (SELECT *, {_CATALOG_FILE_SQL} AS catalog_file FROM videos WHERE entry_pos % 13 <> 5)) WHERE _rn = 1"
)


@register("catalog_build", with_views(_CATALOG_ROWS_SQL, "videos"))
def q_catalog_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse a dump, keep the last video per (catalog, id), write the catalogs (K2), read them back."""
    path = staging_path(spark, "catalog-build")
    _write_catalogs(spark, sf_dir, path)
    return read_catalog_rows(spark, path).select("catalog_file", "id", "title", "duration")


@register(
    "reduce_by_subject",
    with_views(
        "SELECT catalog_file, id, coalesce(title, '') AS title, coalesce(duration, '') AS duration,"
        " split_part(regexp_replace(regexp_replace(replace(catalog_file, '_VideosObject.json', ''), '^.*/', ''), '^_', '@'), '_', 1)"
        " AS subject_name FROM (SELECT *, row_number() OVER (PARTITION BY catalog_file, id ORDER BY entry_pos DESC) AS _rn"
        f" FROM (SELECT *, {_CATALOG_FILE_SQL} AS catalog_file FROM videos WHERE entry_pos % 13 <> 5))"
        f" WHERE _rn = 1 AND ({_literal_sql(CATALOG_TERMS)})",
        "videos",
    ),
)
def q_reduce_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: built catalogs read back (S4), reduced by literal terms, with subject."""
    cat = read_catalog_rows(spark, _staged_catalogs(spark, sf_dir))
    red = manifest_ops.reduce_catalog_rows(cat, CATALOG_TERMS)
    return red.select("catalog_file", "id", "title", "duration", "subject_name")


# ------------------------------------------------------------------ C5: work list

_PLAN_OUT = ["id", "title", "subject_name"]
_HELD_SQL = ("SELECT regexp_replace(filename, '^([.]*[^.].*)[.][^.]*$', '\\1') AS file_id FROM inventory"
             " WHERE quality_dir = 'HighQuality' AND suffix(filename, '.mp4')")
_J1_SQL = f"SELECT * FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM ({_HELD_SQL}) h WHERE h.file_id = m.id)"
_STATUS_SQL = (
    "SELECT m.*, coalesce(l.is_link_found, TRUE) AS is_link_found FROM {src} m LEFT JOIN"
    " (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_name, video_id, video_title ORDER BY ledger_pos)"
    " AS _r FROM link_status) WHERE _r = 1) l"
    " ON l.subject_name = m.subject_name AND l.video_id = m.id AND l.video_title = m.title"
)
_J3_SQL = (
    "SELECT * FROM {src} m WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.quality_dir IS NULL"
    " AND suffix(i.filename, '.mp4') AND i.subject_name = m.subject_name"
    " AND (contains(i.filename, m.id) OR contains(i.filename, m.title)))"
)


@register("anti_held", with_views("SELECT id, title, subject_name FROM (" + _J1_SQL + ")",
                                  "videos", "inventory", extra=_manifest_ctes()))
def q_anti_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest minus media already held (by id, any subject; null ids kept)."""
    return planning.anti_held(_manifest(spark, sf_dir), derived.inventory(spark, sf_dir)).select(*_PLAN_OUT)


@register("status_lookup", with_views("SELECT id, title, subject_name, is_link_found FROM ("
                                      + _STATUS_SQL.format(src="manifest") + ")",
                                      "videos", "link_status", extra=_manifest_ctes()))
def q_status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger status by (subject, id, title), first ledger row, missing = found."""
    return planning.status_lookup(_manifest(spark, sf_dir), derived.link_status(spark, sf_dir)).select(
        *_PLAN_OUT, "is_link_found")


@register("skip_substring", with_views("SELECT id, title, subject_name FROM (" + _J3_SQL.format(src="manifest") + ")",
                                       "videos", "inventory", extra=_manifest_ctes()))
def q_skip_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop videos whose id or title is inside a file name of their subject."""
    return planning.skip_substring(_manifest(spark, sf_dir), derived.inventory(spark, sf_dir)).select(*_PLAN_OUT)


_PLAN_SQL = with_views(
    "SELECT id, title, subject_name, duration FROM ("
    + _J3_SQL.format(src="(SELECT * FROM (" + _STATUS_SQL.format(src="(" + _J1_SQL + ")") + ") WHERE is_link_found)")
    + ")",
    "videos", "inventory", "link_status", extra=_manifest_ctes(),
)


_PLAN_HOT_SQL = with_views(
    "SELECT id, title, subject_name, duration FROM ("
    + _J3_SQL.format(src="(SELECT * FROM (" + _STATUS_SQL.format(src="(" + _J1_SQL + ")") + ") WHERE is_link_found)")
    + ")",
    "videos", "inventory", "link_status", extra=_manifest_ctes(), hot=True,
)


@register("download_plan", _PLAN_SQL)
def q_download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest -> J1 -> J2 -> F11 -> J3: the videos still to fetch."""
    plan = planning.download_plan(_manifest(spark, sf_dir), derived.inventory(spark, sf_dir),
                                  derived.link_status(spark, sf_dir))
    return plan.select(*_PLAN_OUT, "duration")


@register("download_plan_hot_subject", _PLAN_HOT_SQL)
def q_download_plan_hot_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 when one subject holds a third of all videos, files and ledger rows (skew check)."""
    man = manifest_ops.manifest_rows(derived.videos(spark, sf_dir, hot=True))
    plan = planning.download_plan(man, derived.inventory(spark, sf_dir, hot=True),
                                  derived.link_status(spark, sf_dir, hot=True))
    return plan.select(*_PLAN_OUT, "duration")


_DECIMAL_SQL = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


@register(
    "duration_totals",
    with_views(
        "SELECT subject_name, sum(CASE WHEN regexp_matches(trim(coalesce(duration, '0')), " + _DECIMAL_SQL + ")"
        " THEN CAST(trim(coalesce(duration, '0')) AS DOUBLE) END) AS duration_total, count(*) AS n_videos"
        " FROM manifest GROUP BY ROLLUP (subject_name)",
        "videos", extra=_manifest_ctes(),
    ),
)
def q_duration_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + P16: duration goal per subject and overall (null subject = total)."""
    return planning.duration_totals(_manifest(spark, sf_dir))


@register("first_subjects", with_views("SELECT DISTINCT subject_name FROM manifest WHERE subject_name IS NOT NULL"
                                       " ORDER BY subject_name LIMIT 5", "videos", extra=_manifest_ctes()))
def q_first_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + A6: the first five subjects by name."""
    return planning.first_subjects(_manifest(spark, sf_dir), 5)


# ------------------------------------------------------------------ C6: ledger

_LEDGER_OUT = ["subject_name", "video_id", "video_title", "is_link_found", "ledger_pos"]


@register(
    "ledger_upsert",
    with_views(
        """SELECT o.subject_name, o.video_id,
 CASE WHEN n.video_id IS NOT NULL THEN n.t ELSE o.video_title END AS video_title,
 CASE WHEN n.video_id IS NOT NULL THEN n.f ELSE o.is_link_found END AS is_link_found, o.ledger_pos
FROM link_status o LEFT JOIN latest n ON n.subject_name = o.subject_name AND n.video_id = o.video_id
UNION ALL
SELECT n.subject_name, n.video_id, n.t, n.f, n.p FROM latest n
WHERE NOT EXISTS (SELECT 1 FROM link_status o WHERE o.subject_name = n.subject_name AND o.video_id = n.video_id)""",
        "videos", "link_status", "new_status",
        extra={"latest": "SELECT subject_name, video_id, arg_max(video_title, ledger_pos) AS t,"
                         " arg_max(is_link_found, ledger_pos) AS f, min(ledger_pos) AS p FROM new_status GROUP BY 1, 2"},
    ),
)
def q_ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + U1: apply a status batch to the ledger (update by key, else append)."""
    return ledger_ops.upsert_ledger(derived.link_status(spark, sf_dir), derived.new_status(spark, sf_dir)).select(*_LEDGER_OUT)


@register("attempt_outcome", with_views("SELECT video_id, bool_or(success) AS is_downloaded, count(*) AS n_attempts"
                                        " FROM attempts GROUP BY video_id", "attempts"))
def q_attempt_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A video is downloaded when any attempt succeeded."""
    return ledger_ops.attempt_outcome(derived.attempts(spark, sf_dir))


# ------------------------------------------------------------------ C7: media

_LATEST_SQL = ("SELECT subject_name, quality_dir, filename AS latest_file, modification_time AS latest_mtime FROM"
               " (SELECT *, row_number() OVER (PARTITION BY subject_name, quality_dir ORDER BY modification_time DESC, filename DESC)"
               " AS _r FROM inventory WHERE suffix(lower(filename), '.mp4')) WHERE _r = 1")


@register("latest_media", with_views(_LATEST_SQL, "videos", "inventory"))
def q_latest_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest media file per folder."""
    return media_ops.latest_media(derived.inventory(spark, sf_dir))


@register(
    "rename_plan",
    with_views(
        "SELECT * FROM (SELECT * FROM newest UNION ALL SELECT subject_name, 'videoplayback.mp4', id || '.mp4', 'default_name' FROM cur"
        " WHERE subject_name IN (SELECT subject_name FROM inventory WHERE quality_dir IS NULL AND filename = 'videoplayback.mp4')"
        " AND subject_name NOT IN (SELECT subject_name FROM newest)) r"
        " WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.quality_dir IS NULL AND i.subject_name = r.subject_name AND i.filename = r.to_name)",
        "videos", "inventory",
        extra={**_manifest_ctes(), "latest": _LATEST_SQL, "cur":
               "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_name ORDER BY entry_pos DESC) AS _r FROM manifest) WHERE _r = 1",
               "newest":
               "SELECT l.subject_name, l.latest_file AS from_name, c.id || '.mp4' AS to_name, 'newest' AS rule"
               " FROM latest l JOIN cur c ON c.subject_name = l.subject_name WHERE l.quality_dir IS NULL AND l.latest_file <> c.title"},
    ),
)
def q_rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 through its job: the newest flat file's rename, else the default name's; never onto a file that is there."""
    inv = derived.inventory(spark, sf_dir)
    vids = derived.videos(spark, sf_dir)
    cur_src = dedup_videos(vids).select("entry_pos", "id", "title", subject_from_channel("youtuber").alias("subject_name"))
    current = keep_last(cur_src, "subject_name", "entry_pos").select("subject_name", "id", "title")
    return jobs.plan_renames(inv, current).select("subject_name", "from_name", "to_name", "rule")


# ------------------------------------------------------------------ C8: pages

_NAV = r"(?is)<nav(?:\s[^>]*)?>(.*?)</nav\s*>"
_HREF = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"'
_LI = r"(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>"
_TEXT_A = r"(?s)<a\s[^>]*>[^<]*the[^<]*</a>"
_TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
_SITE = "regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"


def _plain(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


def _href_of(x: str) -> str:
    href = _plain(f"regexp_extract({x}, {_sql(_HREF)}, 1)")
    return f"CASE WHEN regexp_matches({x}, {_sql(_HREF)}) THEN CASE WHEN starts_with({href}, '/') THEN {_SITE} || {href} ELSE {href} END END"


def _inner(x: str, pat: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {_sql(pat)}) THEN regexp_extract({x}, {_sql(pat)}, 1) END"


@register(
    "page_links",
    "SELECT page_id, " + _href_of("nav") + " AS container_link,"
    " CASE WHEN len(regexp_extract_all(nav, " + _sql(r"(?is)<li(?:\s[^>]*)?>") + ")) >= 2 THEN "
    + _href_of(_inner("nav", _LI)) + " END AS group_link, "
    "CASE WHEN regexp_matches(html, " + _sql(_TEXT_A) + ") THEN "
    + _href_of("regexp_extract(html, " + _sql(_TEXT_A) + ", 0)") + " END AS text_link, "
    + _plain(_inner("html", _TITLE)) + " AS page_title FROM (SELECT *, " + _inner("html", _NAV) + " AS nav FROM pages)",
)
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 (first link in a container), X2 (first link of the first group), X3 (link by text) of the crawled pages."""
    return page_ops.page_links(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")), page_ops.CRAWLED)


@register(
    "page_markers",
    "SELECT page_id, f AS is_failure, NOT f AS is_link_found, "
    "regexp_matches(html, " + _sql(r'(?is)<html\s[^>]*lang\s*=\s*"[^"]*es[^"]*"[^>]*>') + ") AS has_lang_marker, "
    "coalesce(contains(regexp_replace(" + _inner("html", _NAV) + ", '<[^>]*>', '', 'g'), 'The'), FALSE) AS has_notice FROM (SELECT *, regexp_matches(html, "
    + _sql(r'(?s)<div\s[^>]*class\s*=\s*"[^"]*ad[^"]*"[^>]*>[^<]*the') + ") AS f FROM pages)",
)
def q_page_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4/F10 (failure block), F12 (notice text), language marker of the crawled pages."""
    return page_ops.page_markers(spread(table(spark, sf_dir, "pages").select("page_id", "html")), page_ops.CRAWLED)


# What a result page's fields are, by the rules that its blocks were made by (``derived.result_pages``): no page is parsed here.
_DIR = "CASE WHEN p = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END"
_UP = f"CASE WHEN {_DIR} = '/' THEN '/' ELSE regexp_replace({_DIR}, '[^/]+/$', '') END"
_KEY = "cast(page_id AS varchar)"
_RESULT_FIELDS_SQL = f"""SELECT page_id, CASE WHEN page_id % 11 > 0 THEN CASE page_id % 6
  WHEN 0 THEN 'https://cdn.example.net/f/' || {_KEY} || '.mp4' WHEN 1 THEN site || '/get/' || {_KEY} || '?x=1&y=2' WHEN 2 THEN site || {_UP} || 'up/' || {_KEY} || '.mp4'
  WHEN 3 THEN site || p || '?page=' || {_KEY} WHEN 4 THEN regexp_extract(url, '^[a-z]+:', 0) || '//cdn.example.net/' || {_KEY} ELSE site || {_DIR} || 'a/' || {_KEY} || '#f' END END AS container_link,
 CASE WHEN page_id % 4 >= 2 THEN site || '/g0/' || {_KEY} END AS group_link,
 CASE WHEN page_id % 10 <> 3 THEN site || '/lq/' || {_KEY} || '.mp4?a=1&b=2' END AS text_link,
 page_id % 9 IN (4, 5) AS is_failure, page_id % 9 NOT IN (4, 5) AS is_link_found, page_id % 6 = 2 AS has_notice,
 CASE WHEN page_id % 11 > 0 THEN CASE page_id % 5 WHEN 0 THEN cast(page_id % 900 AS double) WHEN 2 THEN 720.5 WHEN 4 THEN 399.0 END END AS label_value
FROM (SELECT page_id, url, {_SITE} AS site, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM pages)"""


@register("page_threshold", f"SELECT page_id, label_value, coalesce(label_value >= 400, FALSE) AS above_threshold FROM ({_RESULT_FIELDS_SQL})")
def q_page_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 + P17 + F9: numeric label in an element of the result page, compared with 400."""
    return page_ops.page_threshold(derived.result_pages(spark, sf_dir))


@register(
    "url_filename",
    "SELECT page_id, regexp_extract(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '([^/]*)$', 1) AS url_filename FROM pages",
)
def q_url_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file name a URL downloads to."""
    return page_ops.page_url_filename(table(spark, sf_dir, "pages"))


# ------------------------------------------------------------------ P5-P7, P12, P15: names


@register(
    "file_names",
    with_views(
        "SELECT DISTINCT youtuber, 'list_' || youtuber || '_Videos.txt' AS dump_name,"
        " regexp_extract('list_' || youtuber || '_Videos.txt', '^list_(.*?)_', 1) AS channel,"
        " '_' || youtuber || '_Videos_VideosObject.json' AS catalog_name,"
        " '@' || youtuber AS subject_name,"
        " '_' || youtuber || '_Videos_VideosObject_matching_Download_ready' AS manifest_name"
        " FROM videos WHERE youtuber IS NOT NULL",
        "videos",
    ),
)
def q_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 (channel from a dump name), P6 (catalog name), P7 (subject), P12 (manifest name)."""
    ch = derived.videos(spark, sf_dir).where(F.col("youtuber").isNotNull()).select("youtuber").distinct()
    dump = F.concat(F.lit("list_"), F.col("youtuber"), F.lit("_Videos.txt"))
    cat = T.catalog_name_from_dump(dump)
    return ch.select(
        "youtuber", dump.alias("dump_name"), T.channel_from_dump_name(dump).alias("channel"),
        cat.alias("catalog_name"), T.subject_from_catalog_name(cat).alias("subject_name"),
        T.manifest_name_from_input(cat).alias("manifest_name"),
    )


# ------------------------------------------------------------------ A7, A10, C6, C8


@register("ledger_membership", with_views(
    "SELECT id, title, subject_name FROM manifest m WHERE EXISTS (SELECT 1 FROM link_status l"
    " WHERE l.subject_name = m.subject_name AND l.video_id = m.id)", "videos", "link_status", extra=_manifest_ctes()))
def q_ledger_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest videos that already have a ledger row (left semi join on the write key)."""
    man = _manifest(spark, sf_dir).withColumnRenamed("id", "video_id")
    return ledger_ops.in_ledger(man, derived.link_status(spark, sf_dir)).select(
        F.col("video_id").alias("id"), "title", "subject_name")


@register("held_by_id", with_views(
    "SELECT file_id, subject_name FROM (SELECT regexp_replace(filename, '^([.]*[^.].*)[.][^.]*$', '\\1') AS file_id,"
    " subject_name, row_number() OVER (PARTITION BY regexp_replace(filename, '^([.]*[^.].*)[.][^.]*$', '\\1')"
    " ORDER BY subject_name || '/' || coalesce(quality_dir || '/', '') || filename DESC) AS _r"
    " FROM inventory WHERE quality_dir = 'HighQuality') WHERE _r = 1", "videos", "inventory"))
def q_held_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: held file id -> subject; the last listed file (by path) wins."""
    inv = derived.inventory(spark, sf_dir).where(F.col("quality_dir") == F.lit("HighQuality"))
    inv = inv.withColumn("path", F.concat_ws("/", "subject_name", "quality_dir", "filename"))
    return media_ops.held_by_id(inv, order="path")


_PAGE_FAIL = r'(?s)<div\s[^>]*class\s*=\s*"[^"]*ad[^"]*"[^>]*>[^<]*the'


@register(
    "record_status",
    with_views(
        """SELECT o.subject_name, o.video_id,
 CASE WHEN n.video_id IS NOT NULL THEN n.t ELSE o.video_title END AS video_title,
 CASE WHEN n.video_id IS NOT NULL THEN n.f ELSE o.is_link_found END AS is_link_found, o.ledger_pos
FROM link_status o LEFT JOIN latest n ON n.subject_name = o.subject_name AND n.video_id = o.video_id
UNION ALL
SELECT n.subject_name, n.video_id, n.t, n.f, n.p FROM latest n
WHERE NOT EXISTS (SELECT 1 FROM link_status o WHERE o.subject_name = n.subject_name AND o.video_id = n.video_id)""",
        "videos", "link_status",
        extra={
            "batch": "SELECT concat('@', coalesce(v.youtuber, 'None')) AS subject_name, v.id AS video_id,"
                     " v.title AS video_title, NOT regexp_matches(p.html, " + _sql(_PAGE_FAIL) + ") AS is_link_found,"
                     " 200000000 + p.page_id AS ledger_pos FROM pages p JOIN videos v ON v.entry_pos = p.page_id",
            "latest": "SELECT subject_name, video_id, arg_max(video_title, ledger_pos) AS t,"
                      " arg_max(is_link_found, ledger_pos) AS f, min(ledger_pos) AS p FROM batch GROUP BY 1, 2",
        },
    ),
)
def q_record_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page failure markers (X4/F10) -> status batch -> ledger upsert.

    Page ``k`` is the result page seen while fetching the video of entry ``k``.
    """
    pages = page_ops.page_markers(spread(table(spark, sf_dir, "pages").select("page_id", "html")), page_ops.CRAWLED)
    v = derived.videos(spark, sf_dir)
    seen = pages.join(v, pages["page_id"] == v["entry_pos"]).select(
        subject_from_channel("youtuber").alias("subject_name"), F.col("id").alias("video_id"),
        F.col("title").alias("video_title"), "is_failure", (F.lit(200000000) + F.col("page_id")).alias("ledger_pos"))
    batch = ledger_ops.status_batch_from_pages(seen)
    return ledger_ops.upsert_ledger(derived.link_status(spark, sf_dir), batch).select(*_LEDGER_OUT)


@register(
    "page_fields",
    "SELECT r.*, coalesce(r.label_value >= 400, FALSE) AS above_threshold, t.page_title, u.url_filename FROM (" + _RESULT_FIELDS_SQL + ") r"
    " JOIN (" + ORACLES["page_links"] + ") t USING (page_id) JOIN (" + ORACLES["url_filename"] + ") u USING (page_id)",
)
def q_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of a result page, by element, in one scan without a shuffle."""
    return page_ops.extract_page_fields(derived.result_pages(spark, sf_dir))
