"""The scoring stream: console tap, readings and predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from furrow.config import JobConfig
from furrow.operators.readings import clean_readings, earliest, log_extract
from furrow.operators.scoring import ENCODED, score, score_mode
from furrow.schemas import CONSOLE_COLUMNS, project
from furrow.sources.artefacts import load_dictionary, load_model
from furrow.sources.envelope import read_envelope
from furrow.sources.tables import (
    gather_by_date,
    predictions_table,
    readings_table,
    replace_batch,
    require_plain,
    require_streamed,
)


def _writer(df: DataFrame, cfg: JobConfig, query: str, available_now: bool) -> DataStreamWriter:
    """Append-mode writer with the query's own name and checkpoint.

    Micro-batches run back to back unless the configuration sets an interval, such as ``"1 minute"``.
    """
    writer = (
        df.writeStream.outputMode("append")
        .queryName(cfg.query_name(query))
        .option("checkpointLocation", cfg.checkpoint_path(query))
    )
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=cfg.trigger_interval) if cfg.trigger_interval else writer


def _date_sink(df: DataFrame, cfg: JobConfig, query: str, path: str, available_now: bool) -> StreamingQuery:
    require_streamed(df.sparkSession, path)
    rows = gather_by_date(df) if cfg.gather_dates else df
    writer = _writer(rows, cfg, query, available_now)
    return writer.format("parquet").partitionBy("date").option("path", path).start()


def start_readings(clean: DataFrame, cfg: JobConfig, available_now: bool = False) -> StreamingQuery:
    """Readings to Parquet by date, exactly once through the file sink's commit log.

    The log lists every file ever written and the driver reads it, so it grows with a long stream; for one without
    end use :func:`start_fanout`, whose folders a batch job can compact.
    """
    return _date_sink(readings_table(clean), cfg, "readings", cfg.readings_path, available_now)


def start_predictions(
    clean: DataFrame,
    model: PipelineModel,
    cfg: JobConfig,
    dictionary: DataFrame | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Scored readings to Parquet by date, exactly once through the file sink's commit log."""
    scored = predictions_table(score(clean, model, dictionary))
    return _date_sink(scored, cfg, "predictions", cfg.predictions_path, available_now)


def show_rows(batch: DataFrame, batch_id: int, rows: int = 50) -> None:
    """Print the first rows of a micro-batch; only those reach the driver."""
    print(f"batch {batch_id}")
    batch.show(rows, truncate=False)


def start_console(
    clean: DataFrame,
    cfg: JobConfig,
    available_now: bool = False,
    show: Callable[[DataFrame, int, int], None] = show_rows,
) -> StreamingQuery:
    """Show rows of each micro-batch.

    Spark's own console format sends whole batches to the driver before it cuts them; this one asks for the shown
    rows only.
    """
    writer = _writer(project(clean, CONSOLE_COLUMNS), cfg, "console", available_now)
    return writer.foreachBatch(lambda batch, batch_id: show(batch, batch_id, cfg.console_rows)).start()


def fanout_batch(
    clean: DataFrame,
    batch_id: int,
    model: PipelineModel,
    cfg: JobConfig,
    dictionary: DataFrame | None = None,
    show: Callable[[DataFrame, int, int], None] | None = show_rows,
) -> None:
    """Write readings and predictions of one micro-batch and show its earliest rows.

    The batch is read and parsed once and scored once; the shown rows are picked first and scored on their own. Both
    writes replace the partitions of this run's batch, so a replay after a failure at any point leaves each row once,
    and other runs add to the tables. An empty batch writes nothing.
    """
    clean.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # All tasks fill their part of the cache at once; a look for one row would fill one part while the others wait.
        if not clean.count():
            return
        replace_batch(readings_table(clean), cfg.readings_path, batch_id, cfg.gather_dates, cfg.run_id)
        scored = score(clean, model, dictionary)
        replace_batch(predictions_table(scored), cfg.predictions_path, batch_id, cfg.gather_dates, cfg.run_id)
        if show is not None:
            shown = score(earliest(clean, cfg.console_rows), model, dictionary)
            show(log_extract(shown, cfg.console_rows), batch_id, cfg.console_rows)
    finally:
        clean.unpersist()


def start_fanout(
    clean: DataFrame,
    model: PipelineModel,
    cfg: JobConfig,
    dictionary: DataFrame | None = None,
    available_now: bool = False,
    show: Callable[[DataFrame, int, int], None] | None = show_rows,
) -> StreamingQuery:
    """One query that feeds both tables from a single read of the source and shows the earliest rows of each batch.

    A run resumes from its checkpoint. Every batch makes a partition of its own below each date, so choose an interval
    that keeps them few, and bring old dates together now and then
    (:func:`furrow.sources.tables.compact_dates`), which may run beside the stream.
    """
    for path in (cfg.readings_path, cfg.predictions_path):
        require_plain(clean.sparkSession, path)
    writer = _writer(clean, cfg, "fanout", available_now)
    return writer.foreachBatch(
        lambda batch, batch_id: fanout_batch(batch, batch_id, model, cfg, dictionary, show)
    ).start()


def run_stream(
    spark: SparkSession, cfg: JobConfig, available_now: bool = False, fanout: bool = False
) -> list[StreamingQuery]:
    """Start the job: the console tap beside the table writers. The model is loaded first and must be readable.

    Each table has its own query and file sink; ``fanout=True`` reads the source once for both instead.
    """
    model = load_model(cfg.model_path)
    dictionary = load_dictionary(spark, cfg.dictionary_path, required=score_mode(model) == ENCODED)
    clean = clean_readings(read_envelope(spark, cfg.source))
    queries = [start_console(clean, cfg, available_now)]
    if fanout:
        queries.append(start_fanout(clean, model, cfg, dictionary, available_now))
    else:
        queries.append(start_readings(clean, cfg, available_now))
        queries.append(start_predictions(clean, model, cfg, dictionary, available_now))
    return queries
