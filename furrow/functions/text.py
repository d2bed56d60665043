"""Text cleanup for category columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes. Spark's plain trim() removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

SEEDLING_STAGE = "seedling"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind; null stays null."""
    return F.btrim(_column(col), F.lit(WHITESPACE))


def seedling_flag(col: Column | str) -> Column:
    """``Yes`` for the seedling stage in any case or padding, ``No`` for everything else and for null."""
    return F.when(F.lower(strip(col)) == SEEDLING_STAGE, F.lit("Yes")).otherwise(F.lit("No"))


def fill_missing(col: Column | str, text: str = "missing") -> Column:
    """Replace a null category by a text."""
    return F.coalesce(_column(col), F.lit(text))
