"""The record grammar of a dump entry, as native regex Column expressions.

A record is ``| f1 | f2 | ... | f7 | description`` followed by the terminator.
The first seven fields are matched by one anchored regex (the *head*); the
description is everything after the head. Because the description part of the
grammar can always match, the head match alone decides whether the entry parses
and what the first seven fields are, so the description never has to be
scanned by a backtracking regex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelcat.functions.text import ColumnOrName, _col, strip_ws
from reelcat.schemas import RECORD_FIELDS

# The record terminator (the three characters \ _ /) and the
# record grammar of the dump format, exactly as its producer matches records
# (anchored at the start, dot matches newline, Unicode classes).
RECORD_TERMINATOR = "\\_/"
RECORD_PATTERN = (
    r"\|\s*(.*?)\s*\|\s*(.*?)\s*\|\s*(\d+|\w+)\s*\|\s*(.*?)\s*\|\s*(.*?)\s*"
    r"\|\s*([\w-]+)\s*\|\s*(https?://\S+)\s*\|\s*(.*?)\s*\_/"
)
# In that grammar ``\_/`` is an escaped underscore: the description ends at
# the first ``_/``, which leaves the terminator's backslash inside it.
COMPAT_DESCRIPTION_END = "_/"

_DESCRIPTION_PART = r"\s*(.*?)\s*\_/"
HEAD_PATTERN = RECORD_PATTERN[: RECORD_PATTERN.rindex(_DESCRIPTION_PART)]

# The same head, written to be matched in one walk. The first word-only field from
# the third on is the view count, and the field after it the like count: a later
# choice would only lengthen fields before the id, so it never parses more. Each
# text field is a run of pieces (non-blanks, blanks before a non-pipe, and where a
# field may hold pipes, a pipe that doesn't begin what must follow), all possessive.
# Java flags: s = dot matches newline, U = Unicode \w \d \s; \A = match at start.
_FIELD = r"\s*+((?:[^\s|]++|\s++(?!\|))*+)\s*+\|"
_FIELD_UNTIL = r"\s*+((?:[^\s|]++|\s++(?!\|)|\s*+\|(?!{0}))*+)\s*+\|"
_HEAD_JAVA = (
    r"(?sU)\A\|" + _FIELD + _FIELD_UNTIL.format(r"\s*+\w++\s*+\|") + r"\s*+(\w++)\s*+\|" + _FIELD
    + _FIELD_UNTIL.format(r"\s*+[\w-]++\s*+\|\s*+https?://\S+\s*+\|") + r"\s*+([\w-]++)\s*+\|\s*+(https?://\S+)\s*\|"
)


def record_head(entry: ColumnOrName) -> Column:
    """The matched head of a (stripped) entry, or ``''`` when the entry does not parse.

    A match always starts with ``|``, so it is never empty. Regex functions
    decode their whole input, so the entry is matched once here and the seven
    fields are then cut from the (short) head.
    """
    return F.regexp_extract(_col(entry), _HEAD_JAVA, 0)


def entry_parses(entry: ColumnOrName) -> Column:
    """True when the (stripped) entry matches the record grammar."""
    return record_head(entry) != F.lit("")


def record_fields(entry: ColumnOrName, compat: bool = False, head: Column | None = None) -> list[Column]:
    """The eight record fields of a stripped entry, each null when it does not parse.

    ``compat=False`` returns the whole description; ``compat=True`` reproduces
    the producer's literal output (description cut at the first ``_/``, so a
    normal one ends in `` \\``). ``head`` is ``record_head(entry)`` when the
    caller already has it.
    """
    e = _col(entry)
    h = record_head(e) if head is None else head
    ok = h != F.lit("")
    fields = [F.when(ok, F.regexp_extract(h, _HEAD_JAVA, i)) for i in range(1, 8)]
    rest = F.substr(e, F.length(h) + 1)
    if compat:
        rest = F.substring_index(F.concat(rest, F.lit(" " + RECORD_TERMINATOR)), COMPAT_DESCRIPTION_END, 1)
    fields.append(F.when(ok, strip_ws(rest)))
    return [f.alias(name) for f, name in zip(fields, RECORD_FIELDS)]


def render_record(*fields: ColumnOrName) -> Column:
    """Inverse of the grammar: ``| f1 | ... | f8 `` (nulls as empty text)."""
    cols = [F.coalesce(_col(f), F.lit("")) for f in fields]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cols), F.lit(" "))
