"""Turn raw dump entries into ``videos`` rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.functions.grammar import record_fields, record_head
from reelcat.functions.text import channel_from_dump_name, normalize_newlines, strip_ws
from reelcat.schemas import RECORD_FIELDS

STATUS_PARSED = "parsed"
STATUS_EMPTY = "empty"
STATUS_REJECTED = "rejected"
STATUS_NO_CHANNEL = "no_channel"


def classify_entries(raw: DataFrame, compat: bool = False, channel: str | None = None,
                     channel_from_name: bool = True, channel_col: str = "youtuber") -> DataFrame:
    """Classify and parse each raw entry in one pass (no shuffle).

    Output keeps every input row with ``entry_status`` in
    ``parsed | empty | rejected | no_channel`` and the record fields (null unless
    parsed). The channel is ``channel`` when given, else taken from the dump file
    name (``list_<channel>_...``); with neither, ``youtuber`` stays null.
    """
    value = F.col("value")
    # universal newlines only where a \r occurs (a byte search; the regex decodes the whole text)
    entry = strip_ws(F.when(F.contains(value, F.lit("\r")), normalize_newlines(value)).otherwise(value))
    df = (raw.withColumn("entry", entry).withColumn("_head", record_head(F.col("entry")))
          .withColumn("_ok", F.col("_head") != F.lit("")))
    from_name = False
    if channel is not None:
        youtuber: Column = F.lit(channel)
    elif channel_col in raw.columns:
        youtuber = F.col(channel_col)
    elif channel_from_name and "source_name" in raw.columns:
        youtuber = channel_from_dump_name(F.col("source_name"))
        from_name = True
    else:
        youtuber = F.lit(None).cast("string")
    status = (
        F.when(F.col("entry") == F.lit(""), F.lit(STATUS_EMPTY))
        .when(~F.col("_ok"), F.lit(STATUS_REJECTED))
        .when(youtuber.isNull() & F.lit(from_name), F.lit(STATUS_NO_CHANNEL))
        .otherwise(F.lit(STATUS_PARSED))
    )
    keep = [c for c in raw.columns if c not in ("value", channel_col)]
    return df.select(
        *keep,
        F.length(F.col("value")).alias("chars"),
        "entry",
        status.alias("entry_status"),
        *record_fields(F.col("entry"), compat=compat, head=F.col("_head")),
        youtuber.alias("youtuber"),
    )


def parsed_rows(classified: DataFrame) -> DataFrame:
    """the entries that parsed, as ``videos`` rows (plus order columns)."""
    order = [c for c in ("source_file", "source_offset", "source_seq") if c in classified.columns]
    return classified.where(F.col("entry_status") == STATUS_PARSED).select(*order, *RECORD_FIELDS, "youtuber")


def rejected_rows(classified: DataFrame) -> DataFrame:
    """entries that do not fit the grammar (or have no channel), with the reason."""
    order = [c for c in ("source_file", "source_offset", "source_seq") if c in classified.columns]
    return classified.where(F.col("entry_status").isin(STATUS_REJECTED, STATUS_NO_CHANNEL)).select(
        *order, "entry", F.col("entry_status").alias("reason")
    )


def load_counters() -> list[Column]:
    """A3: the plain load counters as aggregate expressions over classified entries.

    ``entries`` counts the chunks the reader emits (a final empty chunk after the
    last terminator is not emitted, unlike ``str.split``); ``chars`` counts the
    characters of those chunks, terminators excluded.
    """
    st = F.col("entry_status")
    return [
        F.count(F.lit(1)).alias("entries"),
        F.count_if(st == STATUS_EMPTY).alias("empty_entries"),
        F.count_if(st == STATUS_PARSED).alias("parsed_entries"),
        F.count_if(st.isin(STATUS_REJECTED, STATUS_NO_CHANNEL)).alias("rejected_entries"),
    ]


def load_metric_columns() -> list[Column]:
    """A3: all load counters, with those of distinct values (which an observation can't hold)."""
    st = F.col("entry_status")
    return [
        *load_counters(),
        F.count_distinct(F.when(st == STATUS_PARSED, F.col("id"))).alias("distinct_ids"),
        F.count_distinct(F.when(st == STATUS_PARSED, F.col("webpage_url"))).alias("distinct_urls"),
    ]


def load_metrics(classified: DataFrame) -> DataFrame:
    """A3 as a one-row DataFrame (partial aggregation; only distinct keys shuffle)."""
    return classified.agg(F.sum("chars").alias("chars"), *load_metric_columns())
