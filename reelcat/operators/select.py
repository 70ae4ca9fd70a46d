"""Choose videos by channel or by title terms.

Terms given as a Python list become one OR-chain of native predicates (the
constant side folds at plan time). Terms given as a DataFrame are joined: a
broadcast nested-loop semi join while the term table is under a checked size,
and an exact gram-index equi join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.functions.text import ColumnOrName, _col
from reelcat.operators.substring import chunks_of, grams_of, grams_of_lengths, spread_over_tasks
from reelcat.session import sized, stage_table

MATCH_LIKE = "like"  # SQL LIKE: % and _ in a term are wildcards, \ escapes
MATCH_LITERAL = "literal"  # plain substring


def term_matches(title: ColumnOrName, term: str | Column, match: str = MATCH_LIKE) -> Column:
    """P9 + F2/F3: case-insensitive match of one term anywhere in the title."""
    t = F.lower(_col(title))
    term_c = F.lit(term) if isinstance(term, str) else term
    if match == MATCH_LIKE:
        return F.like(t, like_pattern(term_c))
    if match == MATCH_LITERAL:
        return F.contains(t, F.lower(term_c))
    raise ValueError(f"unknown match mode {match!r}")


def like_pattern(term: Column) -> Column:
    """The lower-cased pattern ``%term%``; a backslash before an ordinary character means that character.

    A term's last, lone backslash escapes the closing ``%``: such a title ends in a percent sign.
    """
    pattern = F.lower(F.concat(F.lit("%"), term, F.lit("%")))
    return F.regexp_replace(pattern, r"(?s)(\\[%_\\])|\\(.)", "$1$2")


def any_term(title: ColumnOrName, terms: Sequence[str], match: str = MATCH_LIKE) -> Column:
    """OR over the terms (a null title matches nothing)."""
    return reduce(lambda a, b: a | b, [term_matches(title, t, match) for t in terms])


def select_videos(videos: DataFrame, channel: str | None = None, terms: Sequence[str] | None = None,
                  match: str = MATCH_LIKE, title_col: str = "title", channel_col: str = "youtuber") -> DataFrame:
    """a channel wins over terms; no channel and no terms keeps every row.

    An empty channel or an empty term list counts as absent. The channel is a
    Column literal (never pasted into SQL text), so Parquet gets ``EqualTo`` and
    a channel-partitioned table gets partition pruning.
    """
    if channel:
        return videos.where(F.col(channel_col) == F.lit(channel))
    if terms:
        return videos.where(any_term(title_col, list(terms), match))
    return videos


# ---------------------------------------------------------------- J6: terms as a table

# The broadcast path tests every title against every term (titles x terms
# checks); the gram index costs about (gram lengths in use) x title length per
# title. Past a few hundred terms the index wins, whatever the memory allows.
DEFAULT_BROADCAST_TERMS = 256
DEFAULT_BROADCAST_CHARS = 1 << 20  # total term text broadcast at most
ANCHOR = 8


def select_by_term_table(videos: DataFrame, terms: DataFrame, match: str = MATCH_LITERAL,
                         term_col: str = "term", title_col: str = "title",
                         max_broadcast_terms: int = DEFAULT_BROADCAST_TERMS, anchor: int = ANCHOR,
                         max_broadcast_chars: int = DEFAULT_BROADCAST_CHARS) -> DataFrame:
    """Rows whose title matches any term of a term table (left semi join).

    The term table's size is checked first: up to ``max_broadcast_terms`` rows
    holding at most ``max_broadcast_chars`` characters in all, it is broadcast
    and every title is tested against it. Beyond that, an exact gram index is
    used (see ``_semi_join_by_grams``), so the cost follows the candidate pairs
    instead of titles x terms.
    """
    t = terms.select(F.col(term_col).alias("_term")).where(F.col("_term").isNotNull()).distinct()
    head = t.limit(max_broadcast_terms + 1).agg(F.count(F.lit(1)).alias("n"),
                                                F.coalesce(F.sum(F.length("_term")), F.lit(0)).alias("chars")).first()
    if head["n"] <= max_broadcast_terms and head["chars"] <= max_broadcast_chars:
        # the terms' patterns are made once, not for every title
        t = t.select((like_pattern if match == MATCH_LIKE else F.lower)(F.col("_term")).alias("_made"))
        title = F.lower(F.col(title_col))
        met = F.like(title, F.col("_made")) if match == MATCH_LIKE else F.contains(title, F.col("_made"))
        return videos.join(F.broadcast(t), met, "left_semi")
    return _semi_join_by_grams(videos, t, match, title_col, anchor)


#: A run of literal characters in a LIKE pattern, escaped ones included.
_RUN = r"(?s)((?:\\.|[^%_\\])+)"


def _literal_anchor(term: Column, match: str) -> Column:
    """A lower-cased piece of the term that every matching title must contain.

    Literal mode: the term itself. LIKE mode: the longest run of literal characters
    of its pattern, an escaped character counting as itself (empty when the pattern
    is made only of wildcards).
    """
    if match == MATCH_LITERAL:
        return F.lower(term)
    runs = F.regexp_extract_all(like_pattern(term), F.lit(_RUN), F.lit(1))
    literal = F.transform(runs, lambda x: F.regexp_replace(x, r"(?s)\\(.)", "$1"))
    return F.aggregate(literal, F.lit(""), lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc))


def _is_contained(pattern: Column) -> Column:
    """Whether a LIKE pattern asks for one literal text anywhere: ``%`` before and after its one run, no ``_``."""
    runs = F.regexp_extract_all(pattern, F.lit(_RUN), F.lit(1))
    return (F.size(runs) == 1) & ~F.contains(F.regexp_replace(pattern, _RUN, ""), F.lit("_")) & ~F.endswith(pattern, F.get(runs, F.lit(0)))


def _short_pairs(titles: DataFrame, terms: DataFrame, anchor: int, how: str) -> DataFrame | None:
    """Titles joined with the terms of short anchors by grams of the lengths in use (fewer than ``anchor`` values); None without such terms."""
    short = terms.where((F.col("_alen") > 0) & (F.col("_alen") < anchor))
    lengths = sorted(r[0] for r in short.select("_alen").distinct().collect())
    if not lengths:
        return None
    grams = spread_over_tasks(titles, "_tid").select("_tid", F.explode(grams_of_lengths(F.col("_lt"), lengths)).alias("_anc"))
    return grams.join(sized(short.select("_anc", "_made").distinct() if how == "inner" else short.select("_anc").distinct()), "_anc", how)


def _long_pairs(titles: DataFrame, terms: DataFrame, anchor: int) -> DataFrame | None:
    """Titles joined with the terms of long anchors by the rarest chunk of each among these titles; None without such terms."""
    long_ = terms.where(F.col("_alen") >= anchor)
    if long_.isEmpty():
        return None
    chunks = stage_table(long_.select("_made", "_anc", F.explode(chunks_of(F.col("_anc"), anchor)).alias("_gram")), "term-join-chunks")
    tk = spread_over_tasks(titles, "_tid").select("_tid", F.explode(F.array_distinct(grams_of(F.col("_lt"), anchor))).alias("_gram"))
    tk = stage_table(tk.join(sized(chunks.select("_gram")), "_gram", "left_semi"), "term-join-grams")
    holders = tk.groupBy("_gram").agg(F.count(F.lit(1)).alias("_holders"))
    rated = chunks.join(holders, "_gram", "left").withColumn("_holders", F.coalesce("_holders", F.lit(0)))
    best = rated.groupBy("_made", "_anc").agg(F.min("_holders").alias("_fewest"), F.min_by("_gram", "_holders").alias("_gram"))
    return best.where(F.col("_fewest") > 0).join(tk, "_gram")


def _semi_join_by_grams(videos: DataFrame, terms: DataFrame, match: str, title_col: str, anchor: int) -> DataFrame:
    """Exact semi join without a nested loop.

    Titles are matched once per distinct lower-cased title (copies collapse), under a
    short key, then the matched titles are joined back to the rows on ``lower(title)``.
    Each term gets an anchor text (a literal piece it forces into the title):

    * anchors of ``anchor`` chars or more are keyed by their rarest chunk (the
      chunk held by the fewest titles; a chunk held by none rules the term out);
    * shorter anchors are keyed by themselves against title grams of that length;
    * terms with an empty anchor (only wildcards) match every title of at least
      ``n`` chars, ``n`` = their count of ``_``; that needs one number, the least ``n``.

    A title needs one match, so the cheap terms come first: those that ask for their anchor and
    nothing else (a short one is met by the gram itself, a long one by one ``contains``). Only
    titles that none of them matched are paired with the terms that hold wildcards between
    literals, whose patterns are made once a term and tested once a pair. Grams that no anchor
    uses are dropped before anything is shuffled; a pair of title and term comes up once at most.
    """
    titles = videos.where(F.col(title_col).isNotNull()).select(F.lower(F.col(title_col)).alias("_lt")).distinct()
    titles = stage_table(titles.withColumn("_tid", F.monotonically_increasing_id()), "term-join-titles")
    made = (like_pattern if match == MATCH_LIKE else F.lower)(F.col("_term"))
    tm = terms.select(made.alias("_made"), _literal_anchor(F.col("_term"), match).alias("_anc")).distinct()
    tm = tm.withColumns({"_alen": F.length("_anc"), "_plain": _is_contained(F.col("_made")) if match == MATCH_LIKE else F.lit(True)})
    tm = stage_table(tm, "term-join-terms")

    # terms without a literal need one number: the least count of `_` among them (null if none)
    min_len = tm.where(F.col("_alen") == 0).agg(F.min(F.length(F.regexp_replace("_made", "[^_]", "")))).first()[0]
    met = [] if min_len is None else [titles.where(F.length("_lt") >= F.lit(int(min_len))).select("_tid")]
    plain = tm.where("_plain")
    short, long_ = _short_pairs(titles, plain, anchor, "left_semi"), _long_pairs(titles, plain, anchor)
    if short is not None:
        met.append(short.select("_tid"))
    if long_ is not None:
        met.append(long_.join(titles, "_tid").where(F.contains("_lt", "_anc")).select("_tid"))

    wild = tm.where(~F.col("_plain") & (F.col("_alen") > 0))
    if not wild.isEmpty():
        rest = titles
        if met:
            met = [stage_table(reduce(DataFrame.unionByName, met).distinct(), "term-join-met")]
            rest = stage_table(titles.join(met[0], "_tid", "left_anti"), "term-join-rest")
        pairs = [p.select("_tid", "_made") for p in (_short_pairs(rest, wild, anchor, "inner"), _long_pairs(rest, wild, anchor)) if p is not None]
        met.append(reduce(DataFrame.unionByName, pairs).join(rest, "_tid").where(F.like("_lt", F.col("_made"))).select("_tid"))

    if not met:
        return videos.where(F.lit(False))
    matched = titles.join(reduce(DataFrame.unionByName, met).distinct(), "_tid", "left_semi").select("_lt")
    return videos.join(matched, F.lower(F.col(title_col)) == matched["_lt"], "left_semi")
