"""Schemas of the data model: videos, catalog, manifest, ledger, inventory, pages."""

from __future__ import annotations

from pyspark.sql import types as T

# The eight record fields of the dump format, in record order.
RECORD_FIELDS = (
    "upload_date",
    "duration",
    "view_count",
    "like_count",
    "title",
    "id",
    "webpage_url",
    "description",
)

# The six fields that a manifest renders as "NA" when null or empty.
NA_FIELDS = ("upload_date", "duration", "view_count", "like_count", "webpage_url", "description")

VIDEO_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), name != "id") for name in RECORD_FIELDS]
    + [T.StructField("youtuber", T.StringType(), True)]
)

# The stored videos table, its partition column youtuber read as text whatever it looks like.
VIDEOS_STORED = ", ".join(["source_file string", "source_offset long", "source_seq long", *[f"{c} string" for c in RECORD_FIELDS], "youtuber string"])

RECORD_STRUCT = T.StructType([T.StructField(name, T.StringType(), True) for name in RECORD_FIELDS])

# A catalog file: {"videos": {id: record}, "urls": {url: id}}
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("videos", T.MapType(T.StringType(), RECORD_STRUCT), True),
        T.StructField("urls", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

MANIFEST_RECORD_STRUCT = T.StructType(
    RECORD_STRUCT.fields + [T.StructField("subject_name", T.StringType(), True)]
)

# A manifest file: {"search_terms": [..] | "All videos processed", "videos": {id: record}}
# search_terms is read as text and decoded afterwards (it is an array or a sentence).
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("search_terms", T.StringType(), True),
        T.StructField("videos", T.MapType(T.StringType(), MANIFEST_RECORD_STRUCT), True),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("video_id", T.StringType(), True),
        T.StructField("video_title", T.StringType(), True),
        T.StructField("is_link_found", T.BooleanType(), True),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("html", T.StringType(), True),
    ]
)
