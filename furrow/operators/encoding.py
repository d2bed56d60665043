"""Category dictionaries and the encodings built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.text import strip
from furrow.workspace import checkpoint, materialize

DICTIONARY_SCHEMA = "column string, category string, idx long, rows long"
RARE = "__rare__"
MIN_FREQUENCY = 5
SLOT_COLUMNS = ["column", "category", "slot", "slot_name"]
SLOT_SCHEMA = "column string, category string, slot long, slot_name string"


def category_frequency(df: DataFrame, columns: Sequence[str], min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Rows per category of each column, with a mark for those below ``min_frequency``."""
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "column", "category")
        .where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counts.withColumn("rare", F.col("rows") < min_frequency)


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, category, idx, rows)``: stripped categories, numbered from 0 in text order per column.

    The result is a stored table, whose size the planner knows when it joins it.
    """
    counts = category_frequency(df.select(*[strip(c).alias(c) for c in columns]), columns).drop("rare")
    return materialize(_numbered(counts).select("column", "category", "idx", "rows"), "dictionary")


def _numbered(categories: DataFrame) -> DataFrame:
    """Add ``idx``: the place of each category of a column in text order, from 0.

    The distinct categories are range-sorted over the cluster and pinned by a checkpoint; each gets its place from
    its position in its partition plus the sizes of the partitions before, so no task sees a whole vocabulary.
    """
    ordered = checkpoint(categories.sort("column", "category"))
    part = F.spark_partition_id()
    # monotonically_increasing_id holds the partition number above bit 33 and the row's position below it.
    placed = ordered.withColumn("_part", part).withColumn(
        "_pos", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    )
    # One row per partition of the sorted vocabulary.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = offsets.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("_place", F.col("_offset") + F.col("_pos"))
    starts = numbered.groupBy("column").agg(F.min("_place").alias("_start"))
    idx = (F.col("_place") - F.col("_start")).alias("idx")
    return numbered.join(F.broadcast(starts), "column").select(*categories.columns, idx)


def category_slots(dictionary: DataFrame, columns: Sequence[str], min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Rows ``(column, category, slot, slot_name)``: the slot of each category in a one-hot vector.

    Slots are numbered from 0 in text order; categories of fewer than ``min_frequency`` rows share the slot of
    ``RARE``. A stored table of the vocabulary's size, which no single place has to hold.
    """
    name = F.when(F.col("rows") >= min_frequency, F.col("category")).otherwise(RARE).alias("slot_name")
    named = dictionary.where(F.col("column").isin(*columns)).select("column", "category", name)
    slots = _numbered(named.select("column", F.col("slot_name").alias("category")).distinct())
    slots = slots.select("column", F.col("category").alias("slot_name"), F.col("idx").alias("slot"))
    return materialize(named.join(slots, ["column", "slot_name"]).select(*SLOT_COLUMNS), "category-slots")


def _entries(dictionary: DataFrame, column: str, *values) -> DataFrame:
    return dictionary.where(F.col("column") == column).select(F.col("category").alias(column), *values)


def label_encode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], unseen: int = -1) -> DataFrame:
    """Replace categories by their index; unseen and null categories become ``unseen``.

    There is no broadcast hint: a stored dictionary has a known file size, so the planner broadcasts it when it is
    below its threshold and otherwise joins by shuffle, where adaptive execution splits a category that holds much
    of the data.
    """
    encoded = df
    for c in columns:
        entries = _entries(dictionary, c, F.col("idx").alias(f"_{c}_idx"))
        encoded = encoded.join(entries, c, "left").withColumn(
            c, F.coalesce(F.col(f"_{c}_idx"), F.lit(unseen).cast("long"))
        )
    return encoded.select(*df.columns)


def bucket_rare(
    df: DataFrame, dictionary: DataFrame, columns: Sequence[str], min_frequency: int = MIN_FREQUENCY
) -> DataFrame:
    """Frequent categories stay, rare ones share one bucket, unseen ones become null. Joins as in label_encode."""
    mapped = df
    for c in columns:
        entries = _entries(dictionary, c, F.col("rows").alias(f"_{c}_rows"))
        rows = F.col(f"_{c}_rows")
        mapped = mapped.join(entries, c, "left").withColumn(
            c, F.when(rows >= min_frequency, F.col(c)).when(rows.isNotNull(), F.lit(RARE))
        )
    return mapped.select(*df.columns)
