"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcat.session import sized, spread

#: ASCII white space: the separators of words, ``[\x20\x09-\x0D]``.
WHITESPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, over all tasks also if it is one row group."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def whole(c: Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, as an array (JVM side)."""
    inner = F.trim(text, F.lit(WHITESPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\x09-\\x0D]+", -1))


def packed(df: DataFrame) -> DataFrame:
    """Every column in one struct ``row``: results placed beside it clash with no input column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    """The original columns back from ``row``."""
    return df.select("row.*")


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary Arrow array without nulls, as numpy views."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off.astype(np.int64), raw


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of each text: (offsets into the flat word list, flat words). Null counts as empty."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, off = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    keep = np.asarray(pc.not_equal(pc.binary_length(flat), 0))
    before = np.concatenate(([0], np.cumsum(keep)))
    return before[off], flat.filter(pa.array(keep))


def small_batches(batches, max_bytes: int = 8 << 20):
    """Cut Arrow batches so that none much exceeds ``max_bytes`` (one row at least): bounds a task's memory."""
    for batch in batches:
        rows = batch.num_rows
        if rows <= 1 or batch.nbytes <= max_bytes:
            if rows:
                yield batch
            continue
        sizes = np.full(rows, 64, np.int64)
        for col in batch.columns:
            if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
                sizes += np.asarray(pc.fill_null(pc.binary_length(col), 0))
            else:
                sizes += col.nbytes // rows
        part = (np.cumsum(sizes) - sizes) // max_bytes
        edges = np.flatnonzero(np.diff(part)) + 1
        start = 0
        for end in [*edges.tolist(), rows]:
            yield batch.slice(start, end - start)
            start = end


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each (s, n)."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first - starts, lengths)


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def only_ids(docs: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``key`` is (left_semi) or isn't (left_anti) in the staged table ``ids``, null-safe."""
    ids = sized(ids.select(F.col(key).alias("__only_id")))
    return docs.join(ids, docs[key].eqNullSafe(ids["__only_id"]), how)
