"""Registered queries of the jobs and of the operators that touch files.

Inputs are derived from the given tables and written as files under the staging
folder, then read through the real readers; see ``plans.queries`` for the rest.
"""

from __future__ import annotations

import functools
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.functions.text import parse_term_list, subject_from_channel
from reelcat.operators import manifest as manifest_ops
from reelcat.operators.select import MATCH_LIKE, select_by_term_table
from reelcat.plans import jobs, kept_inventory, kept_ledger, latest
from reelcat.plans.queries import (_J1_SQL, _J3_SQL, _MANIFEST_OUT, _PLAN_OUT, _SEL_OUT, _manifest, _manifest_ctes, _like_sql, CATALOG_TERMS, MANIFEST_TERMS,
                                   ORACLES, _CATALOG_FILE_SQL, _STRIP, _LEDGER_OUT, _literal_sql, _staged_catalogs, register)
from reelcat.schemas import RECORD_FIELDS
from reelcat.session import staging_path
from reelcat.sinks.dump import write_dump
from reelcat.sinks.tables import write_ledger, write_manifest_documents
from reelcat.sources import derived
from reelcat.sources.derived import with_views
from reelcat.sources.files import read_ledger
from reelcat.sources.tables import table


def _land(spark: SparkSession, written: str, to: str, name) -> None:
    """Move the part files of ``written/<column>=<value>/`` to ``to/name(value, number)``; file-system calls only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(conf)
    for folder in sorted((s.getPath() for s in fs.listStatus(path(written)) if s.isDirectory()), key=str):
        value = unquote(folder.getName().split("=", 1)[1])
        parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        for k, part in enumerate(parts):
            target = path(f"{to}/{name(value, k)}")
            fs.mkdirs(target.getParent())
            if not fs.rename(part, target):
                raise OSError(f"could not move {part} to {target}")


# ------------------------------------------------------------------ J6: LIKE terms with escapes, both paths

_LIKE_TERMS_SQL = (
    "SELECT DISTINCT unnest([w, replace(w, 'e', '_'), w || '%' || lead_, '\\%', 'a\\_b', '\"q\" ' || w, '100\\' ]) AS term FROM"
    " (SELECT words[i] AS w, coalesce(words[i + 2], '') AS lead_ FROM (SELECT words, unnest(range(1, len(words) + 1)) AS i FROM"
    " (SELECT string_split(lower(text), ' ') AS words FROM benchmark))) WHERE length(w) >= 3")
_LIKE_JOIN_SQL = with_views(
    "SELECT entry_pos, id, title, youtuber FROM videos v WHERE EXISTS (SELECT 1 FROM terms t WHERE lower(v.title) LIKE lower('%' || t.term || '%') ESCAPE '\\')",
    "videos", extra={"terms": _LIKE_TERMS_SQL})


def _like_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIKE terms from every word of every benchmark passage: the word, with wildcards, before the next but one, and escaped wildcards."""
    words = table(spark, sf_dir, "benchmark").select(F.split(F.lower("text"), " ").alias("words"))
    b = words.select("words", F.posexplode("words").alias("i", "w")).where(F.length("w") >= 3)
    later = F.coalesce(F.get("words", F.col("i") + 2), F.lit(""))
    terms = F.array(F.col("w"), F.replace("w", F.lit("e"), F.lit("_")), F.concat("w", F.lit("%"), later), F.lit("\\%"), F.lit("a\\_b"),
                    F.concat(F.lit('"q" '), "w"), F.lit("100\\"))
    return b.select(F.explode(terms).alias("term")).distinct()


@register("select_terms_like", _LIKE_JOIN_SQL)
def q_select_terms_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 in LIKE mode through the gram index: wildcards, escaped wildcards, a last lone backslash."""
    return select_by_term_table(derived.videos(spark, sf_dir), _like_terms(spark, sf_dir), MATCH_LIKE, max_broadcast_terms=0).select(*_SEL_OUT)


@register("select_terms_like_broadcast", _LIKE_JOIN_SQL)
def q_select_terms_like_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 in LIKE mode by the path that the counted terms call for: the same answer (tests hold the broadcast path to it)."""
    return select_by_term_table(derived.videos(spark, sf_dir), _like_terms(spark, sf_dir), MATCH_LIKE).select(*_SEL_OUT)


# ------------------------------------------------------------------ C1, C2 over named dump files

_CHANNELS = ["007", "My Chan", "100%", "Zoé+1"]
_CHANNEL_SQL = "CASE entry_pos % 4 " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(_CHANNELS)) + " END"


def _named_dumps(spark: SparkSession, sf_dir: str) -> str:
    """``list_<channel>_Videos<k>.txt`` files whose channels look like numbers, or hold blanks, percent signs, accents."""
    def build(path: str) -> None:
        v = derived.videos(spark, sf_dir)
        chan = F.element_at(F.array(*map(F.lit, _CHANNELS)), (F.col("entry_pos") % 4).cast("int") + 1)
        lines = v.select(chan.alias("chan"), F.col("entry_pos").alias("k1"), F.concat(F.lit("\n"), derived.render_record(*RECORD_FIELDS)).alias("value"))
        written = staging_path(spark, "named-dump-parts")
        write_dump(lines, written, order_by=["chan", "k1"], partition_by=["chan"])
        _land(spark, written, path, lambda c, k: f"list_{c}_Videos{k:05d}.txt")

    return derived.staged_once(spark, "named-dumps", sf_dir, build)


@register("ingest_videos", with_views(
    "SELECT id, trim(title) AS title, youtuber, ingest_run FROM (SELECT id, title, " + _CHANNEL_SQL + " AS youtuber, 2 AS ingest_run,"
    " row_number() OVER (PARTITION BY id ORDER BY " + _CHANNEL_SQL + " DESC, entry_pos DESC) AS _r FROM videos) WHERE _r = 1", "videos"))
def q_ingest_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 through its job, run twice over named dumps: K1, P2/P5, and A1 on read (the last file, the second run)."""
    path = staging_path(spark, "ingested")
    for _ in range(2):
        jobs.ingest_dump(spark, _named_dumps(spark, sf_dir), path)
    return jobs.latest_videos(spark, path).select("id", "title", "youtuber", "ingest_run")


@register("ingest_incremental", with_views(
    "SELECT id, trim(title) AS title, youtuber, ingest_run FROM (SELECT id, title, " + _CHANNEL_SQL + " AS youtuber, 1 AS ingest_run,"
    " row_number() OVER (PARTITION BY id ORDER BY " + _CHANNEL_SQL + " DESC, entry_pos DESC) AS _r FROM videos) WHERE _r = 1", "videos"))
def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 as an idempotent append, run twice over named dumps: the second run finds no new file and adds no row."""
    path = staging_path(spark, "ingested-new")
    for _ in range(2):
        jobs.ingest_new(spark, _named_dumps(spark, sf_dir), path)
    return jobs.committed_videos(spark, path).select("id", "title", "youtuber", "ingest_run")


# ------------------------------------------------------------------ A1, A2 merged run by run

#: Three runs over the named dumps, by channel.
_RUN_GLOBS = ["list_007_*", "list_{My Chan,100%}_*", "list_Zo*"]
_RUN_SQL = "CASE entry_pos % 4 WHEN 0 THEN 1 WHEN 3 THEN 3 ELSE 2 END"


def _merged_runs(spark: SparkSession, sf_dir: str, key: str) -> str:
    path = staging_path(spark, "ingested-merged")
    for glob in _RUN_GLOBS:
        jobs.ingest_new(spark, _named_dumps(spark, sf_dir), path, glob=glob)
        latest.merge_latest(spark, path, key)
    return path


@register("latest_incremental", with_views(
    "SELECT id, trim(title) AS title, youtuber, ingest_run FROM (SELECT id, title, " + _CHANNEL_SQL + " AS youtuber, " + _RUN_SQL + " AS ingest_run,"
    " row_number() OVER (PARTITION BY id ORDER BY " + _RUN_SQL + " DESC, " + _CHANNEL_SQL + " DESC, entry_pos DESC) AS _r FROM videos) WHERE _r = 1", "videos"))
def q_latest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 kept up to date: three runs, each merged into the buckets that it touches."""
    return latest.kept_latest(spark, _merged_runs(spark, sf_dir, "id")).select("id", "title", "youtuber", "ingest_run")


@register("url_index_incremental", with_views(
    "SELECT webpage_url, id FROM (SELECT webpage_url, id, row_number() OVER (PARTITION BY webpage_url ORDER BY " + _RUN_SQL + " DESC, "
    + _CHANNEL_SQL + " DESC, entry_pos DESC) AS _r FROM videos) WHERE _r = 1", "videos"))
def q_url_index_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/J5 kept up to date over the same runs."""
    return latest.kept_url_index(spark, _merged_runs(spark, sf_dir, "webpage_url"))


def _document_entries(spark: SparkSession, path: str, doc_col: str) -> DataFrame:
    """(doc, key, value) of the entries of written documents; values as JSON text."""
    lines = spark.read.text(path).where(F.col("value").rlike('^(    |  , )"'))
    entry = F.from_json(F.concat(F.lit("{"), F.substr("value", F.lit(5)), F.lit("}")), "map<string,string>")
    return lines.select(F.col(doc_col).alias("doc"), F.explode(entry).alias("key", "json"))


@register("catalog_documents", with_views(
    "SELECT 'one' AS doc, 'videos' AS section, id AS key, trim(coalesce(title, '')) AS v FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY entry_pos DESC) AS _r"
    " FROM rows_) WHERE _r = 1 UNION ALL SELECT 'one', 'urls', webpage_url, id FROM (SELECT *, row_number() OVER (PARTITION BY webpage_url ORDER BY entry_pos DESC) AS _r"
    " FROM rows_) WHERE _r = 1", "videos", extra={"rows_": "SELECT * FROM videos"}))
def q_catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 through its job: both sections of the catalog document, filled independently (A1, A2; K2)."""
    def build(path: str) -> None:
        v = derived.videos(spark, sf_dir)
        lines = v.select(F.lit("x").alias("p"), F.col("entry_pos").alias("k1"), F.concat(F.lit("\n"), derived.render_record(*RECORD_FIELDS)).alias("value"))
        written = staging_path(spark, "one-dump-parts")
        write_dump(lines, written, order_by=["k1"], partition_by=["p"])
        _land(spark, written, path, lambda p, k: f"{k:05d}/list_one.txt")

    dump = derived.staged_once(spark, "one-dump", sf_dir, build)
    rows, documents = staging_path(spark, "catalog-rows"), staging_path(spark, "catalog-documents")
    jobs.build_catalog(spark, f"{dump}/*", rows, documents_path=documents)
    entries = _document_entries(spark, documents, "catalog_file")
    record = F.col("json").startswith("{")
    return entries.select(F.regexp_extract("doc", "^_(.*)_VideosObject", 1).alias("doc"), F.when(record, "videos").otherwise("urls").alias("section"), "key",
                          F.when(record, F.get_json_object("json", "$.title")).otherwise(F.col("json")).alias("v"))


# ------------------------------------------------------------------ K3: values of manifest documents

@register("manifest_documents", with_views("SELECT subject_name AS doc, " + ", ".join(c for c in _MANIFEST_OUT) + " FROM manifest", "videos",
                                          extra=_manifest_ctes(_like_sql(MANIFEST_TERMS))))
def q_manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: every value of the written manifest documents, read back from their lines."""
    rows = manifest_ops.select_manifest(derived.videos(spark, sf_dir), terms=MANIFEST_TERMS)
    path = staging_path(spark, "manifest-documents")
    write_manifest_documents(rows.withColumn("manifest_name", F.col("subject_name")), MANIFEST_TERMS, path)
    record = F.from_json("json", ", ".join(f"{c} string" for c in _MANIFEST_OUT))
    return _document_entries(spark, path, "manifest_name").select("doc", record.alias("r")).select("doc", "r.*")


# ------------------------------------------------------------------ C3, C4 through their jobs

def _written_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc, record fields, subject): a job's manifests, their file name's date as ``<day>``."""
    record = F.from_json("json", ", ".join(f"{c} string" for c in _MANIFEST_OUT))
    undated = [F.regexp_replace(c, "_[0-9]{8}_", "_<day>_") for c in (F.lit(path.rsplit("/", 1)[1]), F.col("doc"))]
    return (_document_entries(spark, path, "manifest_name").select(undated[0].alias("file"), undated[1].alias("doc"), record.alias("r"))
            .select("file", "doc", "r.*"))


_BY_TERMS, _BY_CHANNEL = "videos_search_<day>_matching_Download_ready", "videos_src5_<day>_matching_Download_ready"


@register("select_job", with_views(
    f"SELECT '{_BY_TERMS}' || k AS file, '{_BY_TERMS}' AS doc, {', '.join(_MANIFEST_OUT)} FROM manifest, (VALUES (''), ('_2')) AS n(k)"
    f" UNION ALL SELECT '{_BY_CHANNEL}', '{_BY_CHANNEL}', {', '.join(_MANIFEST_OUT)} FROM by_channel", "videos",
    extra=_manifest_ctes(_like_sql(MANIFEST_TERMS)) | {f"{k}_": q for k, q in _manifest_ctes("youtuber = 'src5'").items() if k == "selected"}
    | {"by_channel": _manifest_ctes()["manifest"].replace("FROM selected", "FROM selected_")}))
def q_select_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 through its job: a bracketed term list (P10) twice, the second under the next free name (P11, K4), and a channel; read back."""
    folder, v = staging_path(spark, "manifests"), derived.videos(spark, sf_dir)
    terms = parse_term_list("[" + ", ".join(f"'{t}'" for t in MANIFEST_TERMS) + "]")
    paths = [jobs.select_videos(spark, v, folder, terms=terms) for _ in range(2)] + [jobs.select_videos(spark, v, folder, channel="src5")]
    return functools.reduce(DataFrame.unionByName, [_written_manifest(spark, p) for p in paths])


@register("reduce_job", with_views(
    "SELECT file, coalesce(replace(catalog_file, '.json', ''), 'None') || '_matching_Download_ready' AS doc, "
    + ", ".join(f"{_STRIP.format(f'coalesce({c}, {chr(39)}{chr(39)})')} AS {c}" for c in RECORD_FIELDS)
    + ", split_part(regexp_replace(replace(catalog_file, '_VideosObject.json', ''), '^_', '@'), '_', 1) AS subject_name"
    " FROM (SELECT *, row_number() OVER (PARTITION BY catalog_file, id ORDER BY entry_pos DESC) AS _rn"
    f" FROM (SELECT *, {_CATALOG_FILE_SQL} AS catalog_file FROM videos WHERE entry_pos % 13 <> 5)), (VALUES ('reduced'), ('reduced_2')) AS n(file)"
    f" WHERE _rn = 1 AND ({_literal_sql(CATALOG_TERMS)})", "videos"))
def q_reduce_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 through its job, twice: every built catalog to a manifest (P7, P8, P12), the second run in the next free folder (K4); read back."""
    folder, catalogs = staging_path(spark, "reduced"), _staged_catalogs(spark, sf_dir)
    paths = [jobs.reduce_catalogs(spark, catalogs, folder, CATALOG_TERMS) for _ in range(2)]
    return functools.reduce(DataFrame.unionByName, [_written_manifest(spark, p) for p in paths])


# ------------------------------------------------------------------ J4, K5 merged batch by batch

@register("ledger_merge", ORACLES["ledger_upsert"])
def q_ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 kept up to date: a ledger, two status batches and the first of them again, cell by cell; the same rows as one upsert."""
    base, status = staging_path(spark, "kept-ledger"), derived.new_status(spark, sf_dir)
    kept_ledger.start_ledger(spark, base, derived.link_status(spark, sf_dir))
    first, second = (status.where(F.col("video_title").endswith(" v2") == again) for again in (True, False))
    for number, batch in ((1, first), (2, second), (1, first)):
        kept_ledger.merge_status(spark, base, batch, number)
    return kept_ledger.kept_status(spark, base).select(*_LEDGER_OUT)


# ------------------------------------------------------------------ S7, S9 over real files, listing by listing

_FILE_SQL = ("SELECT concat('@', coalesce(youtuber, 'None')) AS subject_name, CASE WHEN entry_pos % 9 < 5 THEN 'HighQuality' END AS quality_dir,"
             " entry_pos % 3 AS part, 'b' || cast(entry_pos // 10000 AS varchar) || '+' || cast(entry_pos % 3 AS varchar) || ' 100%.mp4' AS filename, length(id) + 1 AS n FROM videos")


@register("inventory_refresh", with_views(
    "SELECT subject_name, quality_dir, filename, CAST(sum(n) AS BIGINT) AS length, 'added' AS change, CAST(CASE WHEN part = 2 THEN 2 ELSE 1 END AS BIGINT) AS refresh"
    " FROM files GROUP BY subject_name, quality_dir, filename, part", "videos", extra={"files": _FILE_SQL}))
def q_inventory_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7/S8/S9 on real files: two thirds of the media folders listed, then all of them, then all again; every change found, with its refresh."""
    media, base, pos = staging_path(spark, "media"), staging_path(spark, "kept-inventory"), F.col("entry_pos")
    name = F.concat(F.lit("b"), F.floor(pos / 10000).cast("string"), F.lit("+"), (pos % 3).cast("string"), F.lit(" 100%.mp4"))
    file = F.concat_ws("/", subject_from_channel("youtuber"), F.when(pos % 9 < 5, F.lit("HighQuality")), name)
    files = derived.videos(spark, sf_dir).select(file.alias("file"), F.col("id").alias("value"), (pos % 3).alias("part"))
    for late in (False, True):
        written = staging_path(spark, "media-parts")
        files.where((F.col("part") == 2) == late).drop("part").repartition("file").write.partitionBy("file").text(written)
        _land(spark, written, media, lambda f, k: f if k == 0 else f"{f}.{k}")
        kept_inventory.refresh_inventory(spark, media, base)
    kept_inventory.refresh_inventory(spark, media, base)
    return kept_inventory.inventory_changes(spark, base).select("subject_name", "quality_dir", "filename", "length", "change", "refresh")


# ------------------------------------------------------------------ S6, K5, C5 over ledger files

_TITLES = ["%s", " padded %s ", "two\nlines %s", 'he said "hi", %s', "'%s',;|"]


def _odd_title(t):
    pos = F.col("ledger_pos")
    shapes = [F.concat(F.lit(s.split("%s")[0]), t, F.lit(s.split("%s")[1])) for s in _TITLES]
    return F.element_at(F.array(*shapes), (pos % len(_TITLES)).cast("int") + 1)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _odd_title_sql(t: str) -> str:
    return "CASE ledger_pos % 5 " + " ".join(
        f"WHEN {k} THEN {_sql_text(s.split('%s')[0])} || {t} || {_sql_text(s.split('%s')[1])}" for k, s in enumerate(_TITLES)) + " END"


_LEDGER_ROUNDTRIP_SQL = with_views(
    "SELECT subject_name || ' 100%' AS subject_name, video_id, nullif(" + _odd_title_sql("video_title") + ", '') AS video_title, is_link_found FROM link_status", "videos", "link_status")


@register("ledger_roundtrip_whole", _LEDGER_ROUNDTRIP_SQL)
@register("ledger_roundtrip", _LEDGER_ROUNDTRIP_SQL)
def q_ledger_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 -> S6: whole titles with quotes, commas, line breaks and edge blanks, in subject folders with odd names.

    An empty title is an empty CSV field, which reads as null (there and in pandas).
    """
    led = derived.link_status(spark, sf_dir).select(F.concat("subject_name", F.lit(" 100%")).alias("subject_name"), "video_id",
                                                    _odd_title(F.col("video_title")).alias("video_title"), "is_link_found")
    written, base = staging_path(spark, "ledger-parts"), staging_path(spark, "ledgers")
    write_ledger(led, written)
    _land(spark, written, base, lambda subject, k: f"{k}/{subject}/download_status.csv")
    return read_ledger(spark, base).select("subject_name", "video_id", "video_title", "is_link_found")


q_ledger_roundtrip_whole = q_ledger_roundtrip  # one query under two names

@register("plan_first_run", with_views("SELECT id, title, subject_name FROM (" + _J3_SQL.format(src="(" + _J1_SQL + ")") + ")",
                                      "videos", "inventory", extra=_manifest_ctes()))
def q_plan_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 through its job on a first run: no ledger file exists yet."""
    ledger = read_ledger(spark, staging_path(spark, "no-ledger"))
    return jobs.plan_downloads(_manifest(spark, sf_dir), derived.inventory(spark, sf_dir), ledger, jobs.LEDGER_FILE_ORDER)["work"].select(*_PLAN_OUT)
