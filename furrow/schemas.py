"""Declared schemas and the fixed column lists of every output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# Field names and types of the sensor payload.
READING_SCHEMA = T.StructType(
    [
        T.StructField("deviceId", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("cropId", T.StringType()),
        T.StructField("soilType", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("soilMoisture", T.DoubleType()),
        T.StructField("moistureIdx", T.DoubleType()),
        T.StructField("tempC", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

# Header of the training file -> column name used here, with its type.
CROP_COLUMNS = {
    "crop ID": ("crop_id", "string"),
    "soil_type": ("soil_type", "string"),
    "Seedling Stage": ("seedling_stage", "string"),
    "MOI": ("moi", "double"),
    "temp": ("temp", "double"),
    "humidity": ("humidity", "double"),
    "result": ("result", "int"),
}
CROP_SCHEMA = ", ".join(f"{name} {dtype}" for name, dtype in CROP_COLUMNS.values())

LABEL = "result"
LABEL_DOMAIN = (0, 1)
NUMERIC_FEATURES = ["moi", "temp", "humidity"]
CATEGORY_FEATURES = ["crop_id", "soil_type", "seedling_stage"]
FEATURES = NUMERIC_FEATURES + CATEGORY_FEATURES

# The columns of the outputs, in their order.
READINGS_COLUMNS = [
    "deviceId", "ts", "cropId", "soilType", "stage", "moisture01", "moisturePct", "tempC", "humidity", "date",
]
PREDICTIONS_COLUMNS = [
    "deviceId", "ts", "cropId", "stage", "moisturePct", "tempC", "humidity", "needsIrrigation", "date",
]
CONSOLE_COLUMNS = ["ts", "deviceId", "cropId", "stage", "moisturePct", "tempC", "humidity"]
LOG_COLUMNS = [*CONSOLE_COLUMNS, "needsIrrigation"]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise with the names of the columns the table lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of one output, in its order."""
    require_columns(df, columns)
    return df.select(*columns)
