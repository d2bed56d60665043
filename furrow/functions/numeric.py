"""Number coercion and the moisture rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number or an infinity, optionally padded. Java's parser also takes "12d" and hex floats, which are not
# numbers in a sensor payload.
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def nan_to_null(col: Column | str) -> Column:
    """NaN becomes null, so that one missing marker is left."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(c), c)


def to_number(col: Column | str, dtype: str) -> Column:
    """Double from a column of the Spark type ``dtype``; text that is no number becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype == "string":
        c = F.when(c.rlike(NUMBER_TEXT), c).try_cast("double")
    elif dtype != "double":
        c = c.cast("double")
    return nan_to_null(c)


def moisture01(share: Column | str, percent: Column | str) -> Column:
    """Soil moisture as a share: the share field when present, else the percent field / 100. Not clamped."""
    s = F.col(share) if isinstance(share, str) else share
    p = F.col(percent) if isinstance(percent, str) else percent
    return F.coalesce(s, p / F.lit(100.0))
