"""Keep one row per key, the last (or first) in an explicit order.

``row_number() == 1`` over the key lets Catalyst plan a partial
``WindowGroupLimit`` before the shuffle, so a hot key sends at most one row per
map task across the network instead of all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelcat.session import BROADCAST_ROWS, stage_table

ColumnOrName = Column | str


def _cols(cs: Sequence[ColumnOrName] | ColumnOrName) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keep_one(df: DataFrame, keys: Sequence[ColumnOrName] | ColumnOrName,
             order: Sequence[ColumnOrName] | ColumnOrName, last: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest ``order`` when ``last`` else the least.

    Null keys form one group, like a dict key ``None``.
    """
    ordering = [c.desc() if last else c.asc() for c in _cols(order)]
    w = Window.partitionBy(*_cols(keys)).orderBy(*ordering)
    return df.withColumn("_keep_rank", F.row_number().over(w)).where(F.col("_keep_rank") == 1).drop("_keep_rank")


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """A1/A2/A10: last occurrence wins."""
    return keep_one(df, keys, order, last=True)


def keep_last_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_last`` for rows of whole texts: only rows whose key is there more than once are shuffled.

    Repeated keys come from a count over the keys alone and are broadcast; past ``BROADCAST_ROWS`` of
    them all rows are shuffled. ``df`` is read again for each part, and keys alone tell the parts
    apart: the order, which may depend on how a scan is split, is compared within one of them.
    """
    named = [F.col(c).alias(f"_repeated_{c}") for c in keys]
    repeated = stage_table(df.groupBy(*keys).count().where(F.col("count") > 1).select(*named), "repeated-keys")
    n = repeated.count()
    if n == 0:
        return df
    if n > BROADCAST_ROWS:
        return keep_last(df, keys, order)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_repeated_{c}")) for c in keys])
    once, more = (df.join(F.broadcast(repeated), same, how) for how in ("left_anti", "left_semi"))
    return once.unionByName(keep_last(more, keys, order))


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """First occurrence wins."""
    return keep_one(df, keys, order, last=False)


def dedup_videos(videos: DataFrame, order: Sequence[str] = ("entry_pos",)) -> DataFrame:
    """A1: one row per video id, the last entry in ``order`` wins."""
    return keep_last(videos, "id", list(order))


def url_index(videos: DataFrame, order: Sequence[str] = ("entry_pos",)) -> DataFrame:
    """``webpage_url -> id``, the last entry per URL wins."""
    return keep_last(videos.select("webpage_url", "id", *order), "webpage_url", list(order)).select("webpage_url", "id")
