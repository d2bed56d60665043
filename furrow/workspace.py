"""Shared scratch space for intermediate tables, stream checkpoints and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def workspace_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder. The tables are left there when the
    application ends, for it may be resumed or its results read; the folder is named after the application, so that
    a cluster can clear old ones.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = "file://" + tempfile.gettempdir() + "/furrow-workspace"
    return f"{shared.rstrip('/')}/furrow-{context.applicationId}"


# Paths given out inside the innermost :func:`discarded` block.
_GIVEN: ContextVar[list[str] | None] = ContextVar("_GIVEN", default=None)


@contextmanager
def discarded(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that the block wrote to the workspace when it ends, and only those.

    Threads that a block starts take part if they run in a copy of its context.
    """
    given: list[str] = []
    token = _GIVEN.set(given)
    try:
        yield
    finally:
        _GIVEN.reset(token)
        for path in given:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the workspace."""
    path = f"{workspace_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (given := _GIVEN.get()) is not None:
        given.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the workspace and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the file size, by which it decides on
    broadcasting the table.
    """
    return written(df, new_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a path, which a block around :func:`discarded` may have been given, and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; keeps the partitioning and the row order of ``df``."""
    prepare_checkpoints(df.sparkSession)
    return df.checkpoint()


def prepare_checkpoints(spark: SparkSession) -> None:
    """Set the folder of reliable checkpoints, if there is none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(workspace_root(spark))
