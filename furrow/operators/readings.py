"""Decode and normalise sensor readings. Every operator is a narrow projection, usable on batches and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.numeric import moisture01, to_number
from furrow.functions.time import parse_instant
from furrow.schemas import CONSOLE_COLUMNS, LOG_COLUMNS, READING_SCHEMA, project

_CORRUPT = "_corrupt"


def _others(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


def decode_text(envelope: DataFrame) -> DataFrame:
    """Key and value as text; other columns are kept."""
    return envelope.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def decode_envelope(
    envelope: DataFrame, schema: T.StructType = READING_SCHEMA, with_status: bool = False
) -> DataFrame:
    """Flattened payload fields; the key stands in for an absent device id and ``ts`` is kept as ``ts_raw``.

    No row is lost: text that is no JSON object gives a row of nulls. ``with_status`` adds ``decode_status``:
    ``ok``, ``empty`` (no value), ``malformed`` (nothing could be read) or ``partial`` (some field had a wrong type).
    """
    options = {}
    parsed_schema = schema
    if with_status:
        parsed_schema = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
        options = {"columnNameOfCorruptRecord": _CORRUPT}
    kept = _others(envelope, "key", "value")
    text = F.col("value").cast("string")
    parsed = envelope.select(
        *kept,
        F.col("key").cast("string").alias("_key"),
        text.alias("_text"),
        F.from_json(text, parsed_schema, options).alias("_j"),
    )
    columns = []
    for field in schema.fieldNames():
        if field == "deviceId":
            columns.append(F.coalesce(F.col("_j.deviceId"), F.col("_key")).alias("deviceId"))
        else:
            columns.append(F.col(f"_j.{field}").alias("ts_raw" if field == "ts" else field))
    if with_status:
        some_field = F.coalesce(*[F.col(f"_j.{f}").cast("string") for f in schema.fieldNames()]).isNotNull()
        columns.append(
            F.when(F.coalesce(F.trim("_text"), F.lit("")) == "", "empty")
            .when(F.col(f"_j.{_CORRUPT}").isNull() & F.col("_j").isNotNull(), "ok")
            .when(some_field, "partial")
            .otherwise("malformed")
            .alias("decode_status")
        )
    return parsed.select(*kept, *columns)


def harmonize_moisture(df: DataFrame) -> DataFrame:
    """Add ``moisture01`` (share) and ``moisturePct`` (percent) from whichever moisture field is present."""
    share = moisture01("soilMoisture", "moistureIdx")
    return df.withColumn("moisture01", share).withColumn("moisturePct", F.col("moisture01") * F.lit(100.0))


def with_event_time(df: DataFrame) -> DataFrame:
    """Replace ``ts_raw`` by the timestamp ``ts`` and its copy ``event_time``."""
    return (
        df.withColumn("ts", parse_instant("ts_raw")).drop("ts_raw").withColumn("event_time", F.col("ts"))
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, in place; text that is no number becomes null."""
    types = dict(df.dtypes)
    return df.withColumns({c: to_number(c, types[c]) for c in columns})


def clean_readings(envelope: DataFrame, with_status: bool = False) -> DataFrame:
    """Envelope to normalised readings: decode, event time, moisture."""
    return harmonize_moisture(with_event_time(decode_envelope(envelope, with_status=with_status)))


def earliest(clean: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` rows that :func:`log_extract` shows, picked before they are scored: by what scores depend on."""
    order = [F.col(c).asc_nulls_last() for c in [*CONSOLE_COLUMNS, "soilType"]]
    return clean.orderBy(*order).limit(n)


def log_extract(scored: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` earliest rows, rows without a time last; the other columns break ties."""
    rows = project(scored, LOG_COLUMNS)
    ties = [F.col(c).asc_nulls_last() for c in LOG_COLUMNS[1:]]
    return rows.orderBy(F.col("ts").asc_nulls_last(), *ties).limit(n)


def head_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in the order of ``keys``."""
    return df.orderBy(*keys).limit(n)


def is_empty(df: DataFrame) -> bool:
    """Whether a table has no row; stops at the first row found."""
    return df.isEmpty()
