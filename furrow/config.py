"""Typed job configuration."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping
from dataclasses import dataclass, field


def _int(text: str | None) -> int | None:
    return int(text) if text else None


@dataclass(frozen=True)
class SourceConfig:
    """Where envelopes come from: a Kafka topic, or Parquet/JSON files with the same key and value columns."""

    format: str = "kafka"
    bootstrap_servers: str = "kafka:9092"
    topic: str = "sensors"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    path: str | None = None
    streaming: bool = True
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None

    def __post_init__(self) -> None:
        if self.format not in ("kafka", "parquet", "json"):
            raise ValueError(f"unknown source format {self.format!r}")
        if self.format != "kafka" and not self.path:
            raise ValueError("a file source needs a path")

    def kafka_options(self) -> dict[str, str]:
        """Options of Spark's Kafka source. A batch read cannot start at the latest offset."""
        starting = self.starting_offsets
        if not self.streaming and starting == "latest":
            starting = "earliest"
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": starting,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options


@dataclass(frozen=True)
class JobConfig:
    """One streaming job: source, output tables, checkpoints and model.

    ``gather_dates`` shuffles rows by date before they are written; turn it off when a task sees few dates anyway.
    """

    source: SourceConfig = field(default_factory=SourceConfig)
    readings_path: str = "data/sensors_parquet"
    predictions_path: str = "data/predictions_parquet"
    checkpoint_root: str = "checkpoints"
    run_id: str = "stable"
    model_path: str = "models/pipeline"
    dictionary_path: str = "models/dictionary"
    query_prefix: str = "furrow"
    trigger_interval: str | None = None
    gather_dates: bool = True
    console_rows: int = 50

    def checkpoint_path(self, query: str) -> str:
        """Checkpoint folder of one named query of this run."""
        return f"{self.checkpoint_root}/{query}/{self.run_id}"

    def query_name(self, query: str) -> str:
        return f"{self.query_prefix}-{query}-{self.run_id}"

    @staticmethod
    def fresh_run_id() -> str:
        """Run id that starts new checkpoints: the current time."""
        return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d-%H%M%S")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobConfig:
        """Configuration from environment variables. Checkpoints resume unless ``DEV_UNIQUE_CP=1``."""
        env = os.environ if env is None else env
        base = cls()
        source = SourceConfig(
            format=env.get("SOURCE_FORMAT", base.source.format),
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP", base.source.bootstrap_servers),
            topic=env.get("KAFKA_TOPIC", base.source.topic),
            starting_offsets=env.get("STARTING_OFFSETS", base.source.starting_offsets),
            path=env.get("SOURCE_PATH"),
            max_files_per_trigger=_int(env.get("MAX_FILES_PER_TRIGGER")),
            max_offsets_per_trigger=_int(env.get("MAX_OFFSETS_PER_TRIGGER")),
            min_partitions=_int(env.get("KAFKA_MIN_PARTITIONS")),
        )
        return cls(
            source=source,
            readings_path=env.get("SENSORS_PARQUET_PATH", base.readings_path),
            predictions_path=env.get("PREDICTIONS_PARQUET_PATH", base.predictions_path),
            checkpoint_root=env.get("CHECKPOINT_ROOT", base.checkpoint_root),
            run_id=cls.fresh_run_id() if env.get("DEV_UNIQUE_CP", "0") == "1" else base.run_id,
            model_path=env.get("MODEL_PATH", base.model_path),
            dictionary_path=env.get("ENCODERS_PATH", base.dictionary_path),
            trigger_interval=env.get("TRIGGER_INTERVAL"),
            gather_dates=env.get("GATHER_DATES", "1") == "1",
        )
