"""Exact "file name contains needle" matching as equi joins.

J3 asks, per manifest row, whether any file of the same subject contains the
row's id or title as a substring. Testing every (row, file) pair of a subject
is quadratic in the subject's size, and a subject may hold a third of all rows.
Instead each needle is keyed by a short anchor and each file name is cut into
grams of the anchor lengths in use, so the join only meets pairs that share an
anchor; every such candidate is then verified exactly.

* needles of ``anchor`` chars or more: key = their *rarest* chunk. A needle's
  non-overlapping ``anchor``-char chunks (and its last ``anchor`` chars) must
  all occur in a matching name; a table of how many names of the subject hold
  each gram picks the chunk held by the fewest (a chunk held by none proves
  "no match" at once). Each candidate (needle, file) is verified with
  ``contains``. So a series of near-identical names in a hot subject (which
  share their first chunks) costs as many candidates as the rarest chunk has
  holders, not names x needles;
* shorter needles: key = the whole needle, matched against file grams of the
  same length (exact, no verification needed);
* an empty needle is contained in every name: it is keyed as the 0-length
  gram, which each name of the subject holds once.

Needles are made distinct per subject first, so copies of one title or id in
the manifest cost one lookup. All grams of a name are cut in one linear regex
pass (a lookahead at every code point), not by repeated ``substring`` calls,
which re-walk the string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.session import sized, stage_table

DEFAULT_ANCHOR = 12


def grams_of(text: Column, length: int) -> Column:
    """All overlapping ``length``-char grams of ``text`` (code points), in order."""
    # start only at code-point boundaries: never at the low half of a surrogate pair
    # (Java reads a lone low surrogate as itself, so this test is reliable)
    pattern = f"(?s)(?=((?![\\uDC00-\\uDFFF]).{{{length}}}))"
    return F.regexp_extract_all(text, F.lit(pattern), 1)


def chunks_of(text: Column, length: int) -> Column:
    """Non-overlapping ``length``-char chunks of ``text`` plus its last ``length`` chars."""
    body = F.regexp_extract_all(text, F.lit(f"(?s)(.{{{length}}})"), 1)
    return F.array_distinct(F.concat(body, F.array(F.substring(text, -length, length))))


def grams_of_lengths(text: Column, lengths: Sequence[int]) -> Column:
    """The distinct grams of several lengths, one pass per length; as texts, so they are told apart by hash (structs would be compared pair by pair)."""
    arrays = [grams_of(text, n) for n in lengths]
    return F.array_distinct(arrays[0] if len(arrays) == 1 else F.concat(*arrays))


def spread_over_tasks(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` to a fixed number of tasks: gram cutting costs CPU per char, so few bytes must not mean few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def rows_with_contained_needle(needles: DataFrame, files: DataFrame, key_cols: Sequence[str],
                               needle_col: str = "needle", subject_col: str = "subject_name",
                               file_subject_col: str = "subject_name", file_name_col: str = "filename",
                               anchor: int = DEFAULT_ANCHOR, needles_staged: bool = False) -> DataFrame:
    """Distinct ``key_cols`` of needles contained in some file name of their subject.

    ``needles`` has ``key_cols``, ``subject_col`` and ``needle_col`` (null needles
    never match). ``files`` has ``file_subject_col`` and ``file_name_col``.
    Both inputs are staged once (written table), since each feeds several joins;
    ``needles_staged`` tells that the needles are a projection of such a table already.
    """
    keys = list(key_cols)
    nd = needles.where(F.col(needle_col).isNotNull() & F.col(subject_col).isNotNull()).select(
        *keys, F.col(subject_col).alias("_subj"), F.col(needle_col).alias("_needle"), F.length(F.col(needle_col)).alias("_nlen"))
    nd = nd if needles_staged else stage_table(nd, "needles")
    fl = files.where(F.col(file_name_col).isNotNull() & F.col(file_subject_col).isNotNull()).select(
        F.col(file_subject_col).alias("_subj"), F.col(file_name_col).alias("_fname")).distinct()
    fl = stage_table(fl.withColumn("_fid", F.monotonically_increasing_id()), "files")
    spread = spread_over_tasks(fl, "_fid")  # by key: the same on retry

    parts = []
    # short needles (0..anchor-1 chars): exact gram equality, only the lengths in use;
    # an empty needle is the 0-length gram that every name of its subject holds
    short = nd.where(F.col("_nlen") < anchor)
    short_lengths = sorted(r[0] for r in short.select("_nlen").distinct().collect())  # fewer than `anchor`
    if short_lengths:
        grams = []
        positive = [n for n in short_lengths if n > 0]
        if positive:
            grams.append(spread.select("_subj", F.explode(grams_of_lengths(F.col("_fname"), positive)).alias("_needle")).select(
                "_subj", F.length("_needle").alias("_nlen"), "_needle"))
        if 0 in short_lengths:
            grams.append(spread.select("_subj", F.lit(0).alias("_nlen"), F.lit("").alias("_needle")))
        fg = grams[0] if len(grams) == 1 else grams[0].unionByName(grams[1])
        # grams nobody seeks go before the shuffle that makes them distinct
        met = fg.join(sized(short.select("_subj", "_nlen", "_needle")), ["_subj", "_nlen", "_needle"], "left_semi").distinct()
        parts.append(short.join(met, ["_subj", "_nlen", "_needle"], "left_semi").select(*keys))

    # long needles: anchor on the rarest chunk, verify the whole needle
    long_ = nd.where(F.col("_nlen") >= anchor)
    distinct_long = long_.select("_subj", "_needle").distinct()
    chunks = stage_table(distinct_long.select("_subj", "_needle", F.explode(chunks_of(F.col("_needle"), anchor)).alias("_gram")), "chunks")
    fg = spread.select("_subj", "_fid", F.explode(F.array_distinct(grams_of(F.col("_fname"), anchor))).alias("_gram"))
    fg = stage_table(fg.join(sized(chunks.select("_subj", "_gram")), ["_subj", "_gram"], "left_semi"), "file-grams")
    holders = fg.groupBy("_subj", "_gram").agg(F.count(F.lit(1)).alias("_holders"))  # partial aggregation
    rated = chunks.join(holders, ["_subj", "_gram"], "left").select(
        "_subj", "_needle", "_gram", F.coalesce(F.col("_holders"), F.lit(0)).alias("_holders"))
    best = rated.groupBy("_subj", "_needle").agg(
        F.min("_holders").alias("_fewest"), F.min_by("_gram", "_holders").alias("_gram"))
    cand = best.where(F.col("_fewest") > 0).select("_subj", "_needle", "_gram").join(fg, ["_subj", "_gram"])
    named = cand.select("_subj", "_needle", "_fid").join(fl, ["_subj", "_fid"])
    found = named.where(F.contains(F.col("_fname"), F.col("_needle"))).select("_subj", "_needle").distinct()
    parts.append(long_.join(found, ["_subj", "_needle"], "left_semi").select(*keys))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
