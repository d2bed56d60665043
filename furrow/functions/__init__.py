"""Column functions: text, numbers, time. All are JVM-side expressions."""

from furrow.functions.numeric import moisture01, nan_to_null, to_number
from furrow.functions.text import fill_missing, seedling_flag, strip
from furrow.functions.time import event_date, parse_instant

__all__ = [
    "event_date",
    "fill_missing",
    "moisture01",
    "nan_to_null",
    "parse_instant",
    "seedling_flag",
    "strip",
    "to_number",
]
