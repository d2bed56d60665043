"""Sensor records and crop rows derived from the ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

# Columns that identify a source row; carried along to compare row by row.
CROP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream. The pattern matches just that name, be it one file or a folder."""
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def sensor_envelope(events: DataFrame) -> DataFrame:
    """Topic records from events, with every kind of payload defect at a fixed rate.

    Works on the batch table and on its stream. Carries ``event_id``.
    """
    device = F.concat(F.lit("dev-"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    eid = F.col("event_id")
    base = events.select(
        "event_id",
        device.alias("device"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        "event_type",
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    k = F.col("k")
    value = F.col("value")
    payload = F.struct(
        F.when(eid % 7 != 0, F.col("device")).alias("deviceId"),
        F.when(eid % 97 == 0, "not-a-time").otherwise(F.col("ts")).alias("ts"),
        F.when(eid % 13 == 0, None)
        .when(eid % 2 == 0, F.concat(F.lit(" "), "event_type", F.lit(" ")))
        .otherwise(F.col("event_type"))
        .alias("cropId"),
        F.when(k % 3 == 0, "Sandy Soil").when(k % 3 == 1, "loam").otherwise("Black Soil").alias("soilType"),
        F.when(eid % 4 == 0, " Seedling ")
        .when(eid % 4 == 1, "SEEDLING")
        .when(eid % 4 == 2, "Vegetative")
        .otherwise("Flowering")
        .alias("stage"),
        F.when((eid % 11 != 0) & ((eid % 2 == 0) | (eid % 17 == 0)), value / 500).alias("soilMoisture"),
        F.when((eid % 11 != 0) & (eid % 2 == 1), value / 5).alias("moistureIdx"),
        (F.lit(10) + k % 30).cast("double").alias("tempC"),
        k.cast("double").alias("humidity"),
    )
    text = F.when(eid % 103 == 0, None).when(eid % 101 == 0, '{"deviceId":').otherwise(F.to_json(payload))
    return base.select(
        "event_id", F.col("device").cast("binary").alias("key"), text.cast("binary").alias("value")
    )


def props_envelope(events: DataFrame) -> DataFrame:
    """Topic records with the ``props`` text as value and gaps in both parts."""
    eid = F.col("event_id")
    device = F.concat(F.lit("dev-"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    return events.select(
        "event_id",
        F.when(eid % 5 != 0, device).cast("binary").alias("key"),
        F.when(eid % 103 == 0, None).when(eid % 101 == 0, "").otherwise(F.col("props")).cast("binary").alias("value"),
    )


def text_numbers(events: DataFrame) -> DataFrame:
    """Numbers as text in several spellings, some of them no numbers."""
    form = F.col("event_id") % 6
    text = (
        F.when(form == 0, "bad")
        .when(form == 1, F.concat(F.lit(" "), F.col("value").cast("int").cast("string"), F.lit(".5 ")))
        .when(form == 2, F.concat((F.col("user_id") % 50).cast("string"), F.lit("e2")))
        .when(form == 3, "12d")
        .when(form == 4, F.col("props"))
        .otherwise(F.concat(F.lit("-"), F.col("user_id").cast("string")))
    )
    return events.select("event_id", text.alias("tempC"), F.col("user_id").alias("humidity"))


def crop(spark: SparkSession, sf_dir: str, variant: str = "plain", keys: bool = False) -> DataFrame:
    """Labelled crop rows from lineitem.

    ``variant="nulls"`` blanks some moisture values; ``"rare"`` adds soil types of a few rows each.
    """
    soil = F.col("l_linestatus")
    moisture = F.col("l_quantity")
    if variant == "rare":
        rare = F.concat(F.lit("rare"), F.col("l_orderkey").cast("string"))
        soil = F.when(F.col("l_orderkey") <= 7, rare).otherwise(soil)
    if variant == "nulls":
        moisture = F.when(moisture != 7, moisture)
    label = (
        F.when(F.col("l_orderkey") % 20 == 0, 2)
        .when(F.col("l_quantity") + F.col("l_partkey") % 10 < 28, 1)
        .otherwise(0)
    )
    padded = F.concat(F.lit(" "), "l_returnflag")
    return read_table(spark, sf_dir, "lineitem").select(
        *(CROP_KEYS if keys else []),
        F.when(F.col("l_linenumber") % 2 == 0, padded).otherwise(F.col("l_returnflag")).alias("crop_id"),
        soil.alias("soil_type"),
        F.concat(F.lit("S"), F.col("l_linenumber").cast("string")).alias("seedling_stage"),
        moisture.alias("moi"),
        (F.round(F.col("l_tax") * 500) + 0.0).alias("temp"),
        (F.round(F.col("l_discount") * 500) + 0.0).alias("humidity"),
        label.alias("result"),
    )


def rule_score(moisture):
    """A fixed score in place of a trained model: the drier, the higher."""
    return (F.lit(50) - moisture) / F.lit(50.0)


def rule_scored(df: DataFrame) -> DataFrame:
    """Crop rows with the rule's score and class."""
    return df.withColumn("score", rule_score(F.col("moi"))).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


def rule_model() -> PipelineModel:
    """The rule as a pipeline over the shared features; a missing moisture counts as 0."""
    statement = (
        "SELECT *, CAST((50 - coalesce(moi, 0)) / 50.0D >= 0.5D AS DOUBLE) AS prediction FROM __THIS__"
    )
    return PipelineModel(stages=[SQLTransformer(statement=statement)])
