"""The labelled crop table as delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.numeric import to_number
from furrow.schemas import CROP_COLUMNS, require_columns

# Texts that the usual CSV readers for tables take as "no value".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_crop_csv(spark: SparkSession, path: str) -> DataFrame:
    """Crop rows, with columns found by header name and bad numbers as null.

    Only the header is read up front, to check that the seven columns are there; no type inference pass runs. All files
    must have the same header: one that differs, in order too, makes the read fail. A doubled quote stands for one.
    """
    raw = spark.read.options(header=True, enforceSchema=False, escape='"').csv(path)
    require_columns(raw, list(CROP_COLUMNS))
    return raw.select(*[_typed(header, name, dtype) for header, (name, dtype) in CROP_COLUMNS.items()])


def _typed(header: str, name: str, dtype: str):
    text = F.col(f"`{header}`")
    present = F.when(~text.isin(MISSING_TEXTS), text)
    if dtype == "string":
        return present.alias(name)
    number = to_number(present, "string")
    if dtype == "int":
        # A label such as 0.5 is no integer and counts as invalid.
        number = F.when(number == F.floor(number), number).try_cast("int")
    return number.alias(name)


def write_crop_csv(df: DataFrame, path: str) -> None:
    """Write crop rows with the header names of the training file; padding is kept."""
    renamed = df.select(*[F.col(name).alias(header) for header, (name, _) in CROP_COLUMNS.items()])
    (
        renamed.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
