"""Tolerant text-to-number conversion and status flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelcat.functions.text import ColumnOrName, _col, strip_ws

# A plain decimal literal. Everything else (``NA``, ``12d``, ``nan``, ``inf``,
# ``1_000``) becomes null, so one bad text can never turn a sum into NaN and
# engines that disagree on exotic spellings agree on the result.
DECIMAL_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def tolerant_double(text: ColumnOrName) -> Column:
    """Guarded ``try_cast(strip(text) AS DOUBLE)``; null unless a plain decimal."""
    s = strip_ws(text)
    return F.when(s.rlike(DECIMAL_RE), s.try_cast("double"))


def tolerant_duration(text: ColumnOrName) -> Column:
    """A missing duration counts as 0; a present but unparsable one as null."""
    return tolerant_double(F.coalesce(_col(text), F.lit("0")))


def at_least(text: ColumnOrName, threshold: float) -> Column:
    """label >= threshold, false when the label is missing or unparsable."""
    return F.coalesce(tolerant_double(text) >= F.lit(float(threshold)), F.lit(False))


def status_flag(flag: ColumnOrName) -> Column:
    """A missing status counts as found (true)."""
    return F.coalesce(_col(flag), F.lit(True))
