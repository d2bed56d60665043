"""Cleaning and checks of the crop table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import nan_to_null
from furrow.functions.text import strip
from furrow.schemas import CATEGORY_FEATURES, LABEL, LABEL_DOMAIN


def _in_domain(label: str, domain: Sequence[int]):
    return F.coalesce(F.col(label).isin(*domain), F.lit(False))


def _floating(df: DataFrame) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype in ("double", "float")]


def trim_categories(df: DataFrame, columns: Sequence[str] = CATEGORY_FEATURES) -> DataFrame:
    """Strip whitespace around category values."""
    return df.withColumns({c: strip(c) for c in columns})


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column, so that equal rows compare equal."""
    return df.withColumns({c: nan_to_null(c) for c in _floating(df)})


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One row per distinct row. Copies collapse inside each input task before the shuffle."""
    return normalize_missing(df).dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: ``duplicates``, the number of extra copies."""
    copies = normalize_missing(df).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def valid_labels(df: DataFrame, label: str = LABEL, domain: Sequence[int] = LABEL_DOMAIN) -> DataFrame:
    """Rows whose label is in the domain; a null label is dropped too."""
    return df.where(F.col(label).isin(*domain))


def invalid_label_count(df: DataFrame, label: str = LABEL, domain: Sequence[int] = LABEL_DOMAIN) -> DataFrame:
    """One row: ``invalid``, the rows that :func:`valid_labels` removes."""
    return df.agg(F.count_if(~_in_domain(label, domain)).alias("invalid"))


def label_violations(df: DataFrame, label: str = LABEL, domain: Sequence[int] = LABEL_DOMAIN) -> DataFrame:
    """Label values outside the domain with their row counts."""
    return df.where(~_in_domain(label, domain)).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def assert_label_domain(df: DataFrame, label: str = LABEL, domain: Sequence[int] = LABEL_DOMAIN) -> None:
    """Raise when a label value outside the domain is left."""
    bad = [row[label] for row in label_violations(df, label, domain).select(label).take(10)]
    if bad:
        raise ValueError(f"label {label} has values outside {tuple(domain)}: {bad}")


def clean_crop(df: DataFrame) -> DataFrame:
    """Trim, deduplicate, then keep valid labels: the order of the training job."""
    return valid_labels(dedupe_rows(trim_categories(df)))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the table's row and column counts."""
    columns = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(dtype).alias("type"))
            for i, (name, dtype) in enumerate(df.dtypes)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
    return counted.select(F.inline(columns), "n_rows", "n_columns")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, NaN included, in one pass."""
    floating = set(_floating(df))

    def missing(c: str):
        test = F.col(c).isNull()
        return test | F.isnan(c) if c in floating else test

    counts = df.agg(*[F.count_if(missing(c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def category_cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per category column."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    counts = df.agg(*[distinct(F.col(c)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "categories")


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label value, in label order."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)


def label_share(df: DataFrame, label: str = LABEL, by: str | None = None) -> DataFrame:
    """Share of each label, over the table or within each value of ``by`` (a split)."""
    keys = [by] if by else []
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy(*keys).agg(F.sum("rows").alias("_total"))
    joined = counts.join(totals, by) if by else counts.crossJoin(F.broadcast(totals))
    return joined.select(*keys, label, "rows", (F.col("rows") / F.col("_total")).alias("share"))


def distinct_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Label values in order."""
    return df.select(label).distinct().orderBy(label)
