from __future__ import annotations

import pytest

from furrow.config import JobConfig, SourceConfig
from furrow.sources.envelope import read_envelope, write_envelope


def test_kafka_stream_options():
    cfg = SourceConfig(topic="t", bootstrap_servers="b:1", max_offsets_per_trigger=10, min_partitions=64)
    assert cfg.kafka_options() == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "64",
    }


def test_kafka_batch_starts_at_the_earliest_offset():
    options = SourceConfig(streaming=False, max_offsets_per_trigger=10).kafka_options()
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options


def test_unusable_sources():
    with pytest.raises(ValueError, match="format"):
        SourceConfig(format="pigeon")
    with pytest.raises(ValueError, match="path"):
        SourceConfig(format="json")


def test_job_from_environment():
    cfg = JobConfig.from_env({"STARTING_OFFSETS": "earliest", "MODEL_PATH": "/m", "KAFKA_BOOTSTRAP": "x:9"})
    assert cfg.source.starting_offsets == "earliest" and cfg.source.bootstrap_servers == "x:9"
    assert cfg.model_path == "/m"
    assert cfg.checkpoint_path("console") == "checkpoints/console/stable"


def test_run_id_of_its_own():
    cfg = JobConfig.from_env({"DEV_UNIQUE_CP": "1"})
    assert cfg.run_id != "stable" and cfg.run_id in cfg.checkpoint_path("console")
    assert cfg.run_id in cfg.query_name("console")


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_file_sources_give_the_same_envelope(spark, path, kind):
    cfg = SourceConfig(format=kind, path=path(kind), streaming=False)
    records = spark.createDataFrame([(b"k", b'{"a": 1}'), (None, None)], "key binary, value binary")
    write_envelope(records, cfg)
    found = {(r.key and bytes(r.key), r.value and bytes(r.value)) for r in read_envelope(spark, cfg).collect()}
    assert found == {(b"k", b'{"a": 1}'), (None, None)}


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_file_sources_stream(spark, path, kind):
    cfg = SourceConfig(format=kind, path=path(kind), max_files_per_trigger=1)
    records = spark.createDataFrame([(b"k%d" % i, b"{}") for i in range(6)], "key binary, value binary")
    write_envelope(records.repartition(3), cfg)
    stream = read_envelope(spark, cfg).writeStream.format("parquet").option("path", path("out"))
    stream.option("checkpointLocation", path("cp")).trigger(availableNow=True).start().awaitTermination()
    landed = spark.read.parquet(path("out"))
    assert {bytes(r.key) for r in landed.collect()} == {b"k%d" % i for i in range(6)}
    assert landed.dtypes == [("key", "binary"), ("value", "binary")]
