"""Bounded samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_per_class(rows: DataFrame, class_col: str, id_col: str, most: int) -> DataFrame:
    """About ``most`` rows of each class, or all it has, with the ``weight`` that keeps the class's share.

    A row is taken if the hash of its id falls below the share of its class that is wanted, so rows are neither sorted
    nor moved; what is broadcast is one row per class. Rows without class are left out.
    """
    counts = rows.where(F.col(class_col).isNotNull()).groupBy(F.col(class_col).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    classes = counts.select("_class", F.least(F.lit(1.0), F.lit(float(most)) / F.col("_n")).alias("_share"))
    # The hash is even over the 64-bit integers.
    place = F.xxhash64(F.col(id_col)) / F.lit(2.0**64) + F.lit(0.5)
    taken = (F.col(class_col) == F.col("_class")) & ((place < F.col("_share")) | (F.col("_share") == 1))
    return rows.join(F.broadcast(classes), taken).select(*rows.columns, (1 / F.col("_share")).alias("weight"))


def remainder(id_col: str, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
