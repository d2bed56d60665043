"""Event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(col: Column | str) -> Column:
    """ISO-8601 text to timestamp; text that is no instant becomes null under ANSI mode too."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def event_date(col: Column | str) -> Column:
    """Partition date of a timestamp."""
    return F.to_date(F.col(col) if isinstance(col, str) else col)
