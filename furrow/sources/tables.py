"""Date-partitioned output tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.functions.time import event_date
from furrow.schemas import PREDICTIONS_COLUMNS, READINGS_COLUMNS, project
from furrow.workspace import materialize

STREAM_LOG = "_spark_metadata"
COMPACTIONS = "_compactions"  # a folder that readers of the table do not see
COMPACTED = "compacted-"  # with which the run of compacted rows begins
MANIFEST_SCHEMA = "date string, run_id string, batch_id long, into string"


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", event_date("ts"))


def readings_table(clean: DataFrame) -> DataFrame:
    """Rows of the readings table."""
    return project(with_date(clean), READINGS_COLUMNS)


def predictions_table(scored: DataFrame) -> DataFrame:
    """Rows of the predictions table."""
    return project(with_date(scored), PREDICTIONS_COLUMNS)


def _holds(spark: SparkSession, path: str, hidden: bool) -> bool:
    """Whether a folder has the commit log of a native stream (``hidden``), or anything that readers see."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return STREAM_LOG in names if hidden else any(name[0] not in "._" for name in names)


def require_plain(spark: SparkSession, path: str) -> None:
    """Refuse a table that a native stream has written: its log hides the files of every other writer."""
    if _holds(spark, path, hidden=True):
        raise ValueError(f"{path} was written by a native stream, whose log would hide these rows: choose another path")


def require_streamed(spark: SparkSession, path: str) -> None:
    """Refuse a table with rows of another writer: the log of a native stream would hide them."""
    if _holds(spark, path, hidden=False) and not _holds(spark, path, hidden=True):
        raise ValueError(f"{path} holds rows that a native stream's log would hide: choose another path")


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """The readings table of any writer, in its contract's columns."""
    return project(live_rows(spark, path), READINGS_COLUMNS)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The predictions table of any writer, in its contract's columns."""
    return project(live_rows(spark, path), PREDICTIONS_COLUMNS)


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows ``(date, run_id, batch_id, into)``: partitions whose rows now stand in the run ``into``."""
    if not _holds(spark, f"{path}/{COMPACTIONS}", hidden=False):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/{COMPACTIONS}")


def live_rows(spark: SparkSession, path: str) -> DataFrame:
    """Each row of a table once, whatever compactions have begun, ended or broken off.

    A partition that a manifest names is left out, also when a replay has written it again, and so is a compacted one
    that no manifest names yet.
    """
    rows = spark.read.parquet(path)
    if not {"run_id", "batch_id"} <= set(rows.columns):
        return rows
    compacted = F.col("run_id").startswith(COMPACTED)
    manifests = _manifests(spark, path)
    if manifests is None:
        return rows.where(~compacted)
    gone = manifests.select(*[F.col(c).alias(f"_{c}") for c in ("date", "run_id", "batch_id")])
    same = (F.col("date").cast("string") == F.col("_date")) & (F.col("run_id") == F.col("_run_id"))
    known = manifests.select(F.col("into").alias("_into")).distinct()
    rows = rows.join(gone, same & (F.col("batch_id") == F.col("_batch_id")), "left_anti")
    done = rows.where(compacted).join(known, F.col("run_id") == F.col("_into"), "left_semi")
    return rows.where(~compacted).unionByName(done)


def compact_dates(spark: SparkSession, path: str, before: str) -> int:
    """Rewrite the dates before ``before`` (``YYYY-MM-DD``) so that each is one partition; returns how many partitions went.

    For tables of :func:`replace_batch`, beside a running stream: rows that arrive late, and replays of batches, are
    separate partitions, which the next compaction takes in. The rows are written first, then a manifest, in one file,
    puts them in place of their sources in one step, then the sources are deleted. A compaction that breaks off leaves
    either its sources or its rows to :func:`live_rows`, and what it wrote for nothing, or did not delete, is deleted
    by the next one. Run one at a time for a table. Rows without a date stay where they are.
    """
    require_plain(spark, path)
    _clear(spark, path)
    into = COMPACTED + uuid.uuid4().hex
    closed = live_rows(spark, path).where(F.col("date").cast("string") < before)
    sources = closed.select(F.col("date").cast("string").alias("date"), "run_id", F.col("batch_id").cast("long").alias("batch_id"))
    sources = sources.distinct().withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy("date")))
    sources = materialize(sources.where("_parts > 1").select("date", "run_id", "batch_id"), "compaction")
    count = sources.count()
    if not count:
        return 0
    dates = sources.select(F.col("date").alias("_date")).distinct()
    rows = closed.join(dates, F.col("date").cast("string") == F.col("_date"), "left_semi")
    named = {"run_id": F.lit(into), "batch_id": F.lit(0).cast("long")}
    gather_by_date(rows).withColumns(named).write.mode("append").partitionBy("date", "run_id", "batch_id").parquet(path)
    manifest = sources.withColumn("into", F.lit(into)).coalesce(1)  # one file, so that it appears in one step
    manifest.write.parquet(f"{path}/{COMPACTIONS}/{into}")
    _clear(spark, path)
    return count


def _clear(spark: SparkSession, path: str) -> None:
    """Delete partitions that manifests name, and compacted ones that none names."""
    if not _holds(spark, path, hidden=False):
        return
    manifests = _manifests(spark, path)
    found = spark.read.parquet(path)
    if not {"run_id", "batch_id"} <= set(found.columns):
        raise ValueError(f"{path} has no partitions by run and batch")
    # A row per partition folder, read from the folders' names alone.
    parts = found.select(F.col("date").cast("string").alias("date"), "run_id", F.col("batch_id").cast("long").alias("batch_id")).distinct()
    if manifests is None:
        gone = parts.where(F.col("run_id").startswith(COMPACTED))
    else:
        replaced = parts.join(manifests, ["date", "run_id", "batch_id"], "left_semi")
        named = manifests.select(F.col("into").alias("run_id"))
        stray = parts.where(F.col("run_id").startswith(COMPACTED)).join(named, "run_id", "left_anti")
        gone = replaced.unionByName(stray.select(*parts.columns)).distinct()
    jvm = spark.sparkContext._jvm
    escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for part in gone.toLocalIterator():  # folder names
        folder = jvm.org.apache.hadoop.fs.Path(
            f"{path}/date={part['date']}/run_id={escaped(part['run_id'])}/batch_id={part['batch_id']}"
        )
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def gather_by_date(df: DataFrame) -> DataFrame:
    """Bring the rows of a date together, so that a write makes few files instead of one per task and date.

    Adaptive execution then splits a date that holds much of the data over several tasks. Without it rows stay where
    they are, for a plain shuffle by date would put a whole date into one task.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", F.col("date")) if adaptive else df


def append_by_date(df: DataFrame, path: str) -> None:
    """Append a batch, partitioned by date. A table of a native stream is refused."""
    require_plain(df.sparkSession, path)
    gather_by_date(df).write.mode("append").partitionBy("date").parquet(path)


def write_readings(clean: DataFrame, path: str) -> None:
    append_by_date(readings_table(clean), path)


def write_predictions(scored: DataFrame, path: str) -> None:
    append_by_date(predictions_table(scored), path)


def replace_batch(df: DataFrame, path: str, batch_id: int, gather: bool = True, run_id: str = "stable") -> None:
    """Write one micro-batch so that writing it again leaves the same rows.

    Every batch of a run owns the partitions ``date=*/run_id=<run>/batch_id=<id>``; a replay overwrites just those, and
    other runs, whose ids start at 0 again, only add to the table. A table of a native stream is refused, and so is a
    run with a name of compacted rows.
    """
    if run_id.startswith(COMPACTED):
        raise ValueError(f"run ids that begin with {COMPACTED!r} are those of compacted rows")
    require_plain(df.sparkSession, path)
    rows = gather_by_date(df) if gather else df
    (
        rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "run_id", "batch_id")
        .parquet(path)
    )
