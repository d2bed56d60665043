"""Topic records: a binary key and a binary JSON value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.config import SourceConfig
from furrow.schemas import ENVELOPE_SCHEMA, READING_SCHEMA


def read_envelope(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Key and value of every record, as a stream or as a batch."""
    reader = spark.readStream if cfg.streaming else spark.read
    if cfg.format == "kafka":
        df = reader.format("kafka").options(**cfg.kafka_options()).load()
        return df.select("key", "value")
    if cfg.streaming and cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    if cfg.format == "parquet":
        return reader.schema(ENVELOPE_SCHEMA).parquet(cfg.path)
    text = reader.schema("key string, value string").json(cfg.path)
    return text.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def encode_envelope(df: DataFrame, key_col: str = "deviceId") -> DataFrame:
    """Readings to topic records. Null fields are left out of the JSON text."""
    fields = [f.name for f in READING_SCHEMA if f.name in df.columns]
    return df.select(
        F.col(key_col).cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def write_envelope(df: DataFrame, cfg: SourceConfig) -> None:
    """Append topic records to the topic or folder of ``cfg``."""
    if cfg.format == "kafka":
        options = {"kafka.bootstrap.servers": cfg.bootstrap_servers, "topic": cfg.topic}
        df.select("key", "value").write.format("kafka").options(**options).save()
    elif cfg.format == "parquet":
        df.select("key", "value").write.mode("append").parquet(cfg.path)
    else:
        text = df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
        text.write.mode("append").json(cfg.path)


def raw_tap(envelope: DataFrame) -> DataFrame:
    """One ``key:value`` line per record; an absent or empty part shows as ``None``."""

    def shown(name: str):
        text = F.col(name).cast("string")
        return F.when(text != "", text).otherwise(F.lit("None"))

    return envelope.select(F.concat(shown("key"), F.lit(":"), shown("value")).alias("line"))
