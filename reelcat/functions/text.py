"""Scalar text functions as native Column expressions (no Python per row).

Each function takes and returns a ``Column``; the Python-side helpers at the
bottom work on driver-side parameters only (search terms, output names).
"""

from __future__ import annotations

import datetime as _dt
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Whitespace as Python's ``str.strip()`` sees it (every code point whose
# ``isspace()`` is true), built from that rule so a native ``btrim`` strips
# exactly what the record format's producer strips.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# Fixed values of the media layout and of the manifest format.
NA_TEXT = "NA"
SUBJECT_PREFIX = "@"
NULL_CHANNEL_TEXT = "None"
MEDIA_EXTENSION = ".mp4"
CATALOG_SUFFIX = "_VideosObject.json"
MANIFEST_SUFFIX = "_matching_Download_ready"
ALL_VIDEOS_SENTENCE = "All videos processed"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading and trailing Unicode whitespace (Python ``str.strip``)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def normalize_newlines(c: ColumnOrName) -> Column:
    """Universal newlines: ``\\r\\n`` and a lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def na_fill(c: ColumnOrName) -> Column:
    """Null or empty text becomes the literal ``NA``."""
    c = _col(c)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NA_TEXT))


def subject_from_channel(channel: ColumnOrName) -> Column:
    """``@`` + channel; a null channel renders as ``@None``."""
    return F.concat(F.lit(SUBJECT_PREFIX), F.coalesce(_col(channel), F.lit(NULL_CHANNEL_TEXT)))


def has_dump_channel(file_name: ColumnOrName) -> Column:
    """P5 guard: does the dump file name start with ``list_<channel>_``."""
    return _col(file_name).rlike("^list_.*?_")


def channel_from_dump_name(file_name: ColumnOrName) -> Column:
    """P5: text between a leading ``list_`` and the next ``_`` (null when absent)."""
    c = _col(file_name)
    return F.when(has_dump_channel(c), F.regexp_extract(c, "^list_(.*?)_", 1))


def path_basename(path: ColumnOrName) -> Column:
    """Last path segment of a ``/``-separated path."""
    return F.regexp_extract(_col(path), "([^/]*)$", 1)


def decoded_path(path: ColumnOrName) -> Column:
    """A path or file name as stored: Spark's ``_metadata`` columns hold it URI-encoded (``+`` stands for itself)."""
    return F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))


def file_stem(file_name: ColumnOrName) -> Column:
    """Drop the last extension as ``os.path.splitext`` does.

    Leading dots never start an extension: ``a.b.mp4 -> a.b``, ``.mp4 -> .mp4``,
    ``.a..mp4 -> .a.``.
    """
    return F.regexp_replace(_col(file_name), r"(?s)^([.]*[^.].*)[.][^.]*$", "$1")


def catalog_name_from_dump(file_name: ColumnOrName) -> Column:
    """Dump ``list_Chan_Videos.txt`` -> catalog ``_Chan_Videos_VideosObject.json``."""
    stem = file_stem(path_basename(file_name))
    return F.concat(F.substr(stem, F.lit(5)), F.lit(CATALOG_SUFFIX))


def subject_from_catalog_name(path: ColumnOrName) -> Column:
    """Catalog file name -> subject.

    Remove the catalog suffix, keep the base name, turn one leading ``_`` into
    ``@`` and cut at the first remaining ``_``.
    """
    base = path_basename(F.replace(_col(path), F.lit(CATALOG_SUFFIX), F.lit("")))
    return F.split_part(F.regexp_replace(base, "^_", SUBJECT_PREFIX), F.lit("_"), F.lit(1))


def manifest_name_from_input(path: ColumnOrName) -> Column:
    """Input stem + ``_matching_Download_ready``."""
    return F.concat(file_stem(path_basename(path)), F.lit(MANIFEST_SUFFIX))


def media_name(video_id: ColumnOrName) -> Column:
    """``{id}.mp4``."""
    return F.concat(_col(video_id), F.lit(MEDIA_EXTENSION))


def is_media_file(file_name: ColumnOrName, case_sensitive: bool = True) -> Column:
    """F8: ``.mp4`` suffix, exact case or any case."""
    c = _col(file_name)
    return c.endswith(MEDIA_EXTENSION) if case_sensitive else F.lower(c).endswith(MEDIA_EXTENSION)


def url_path(url: ColumnOrName) -> Column:
    """Path component of a URL (after scheme and authority, before ``?`` or ``#``)."""
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_filename(url: ColumnOrName) -> Column:
    """Last segment of the URL path, without ``;params``."""
    return F.regexp_replace(path_basename(url_path(url)), ";.*$", "")


def parse_term_list_col(text: ColumnOrName) -> Column:
    """P10 as a Column: ``"[a, 'b']"`` -> ``["a", "b"]``."""
    inner = F.regexp_replace(_col(text), r"^[\[\]]+|[\[\]]+$", "")
    parts = F.split(F.replace(inner, F.lit("'"), F.lit("")), ",", -1)
    return F.transform(parts, strip_ws)


# ---------------------------------------------------------------- driver-side


def parse_term_list(text: str | None) -> list[str]:
    """P10 on a command-line value; no value gives no terms (an empty list)."""
    if text is None:
        return []
    return [t.strip() for t in text.strip("[]").replace("'", "").split(",")]


def manifest_base_name(channel: str | None, terms: list[str] | None, day: _dt.date | None = None) -> str:
    """``videos_{channel}_{search}_{yyyyMMdd}_matching_Download_ready``."""
    parts = []
    if channel:
        parts.append(channel)
    if terms:
        parts.append("search")
    if not parts:
        parts.append("all")
    day = day or _dt.date.today()
    return f"videos_{'_'.join(parts)}_{day.strftime('%Y%m%d')}{MANIFEST_SUFFIX}"
