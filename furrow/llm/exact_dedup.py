"""Exact deduplication by a stateful stream.

A stream of content marks (digest, identifier, locator) runs through a keyed aggregation whose state lives on disk in
RocksDB and never expires. Per digest it retains the first identifier, the locator of its content and the number of
copies. A digest with more than one row is a hit; the full bytes of its rows are then compared with those at the
retained locator. Rows whose bytes differ in spite of an equal digest form groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.tables import BLANKS
from furrow.schemas import require_columns
from furrow.workspace import discarded, materialize, new_path, written

STATE = "spark.sql.streaming.stateStore"
DISK_BACKED = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: do not reserve megabytes of disk for the log of each.
    f"{STATE}.rocksdb.allowFAllocate": "false",
    # One bound on the memory of all stores of an executor.
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "128",
}
FILES_PER_BATCH = 10_000  # of marks, in a micro-batch
MARKS_SCHEMA = "digest binary, first struct<no_id:boolean,id:bigint,file:string,pos:bigint>"


def normalised(text: Column) -> Column:
    """Text with every run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``row`` with the locator ``(file, pos)`` of each row's content.

    A table that is not read from Parquet files is first written to the workspace.
    """
    if "_metadata" not in docs.columns:
        try:
            return docs.select(
                F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("pos"),
            )
        except AnalysisException:
            pass
    stored = materialize(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")), "contents")
    return stored.select(
        "row", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos")
    )


def first_seen(spark: SparkSession, marks: str) -> DataFrame:
    """``(digest, first, copies)`` of the stored table of marks at ``marks``, kept by a stream without expiry.

    The stream's state is one row per digest. Each micro-batch writes the digests it changed into a folder of its
    own, which a repeated batch overwrites; the last state of a digest has the smallest ``first`` and most copies.
    """
    target, log = new_path(spark, "first-seen"), new_path(spark, "first-seen-log")
    kept = (
        spark.readStream.schema(MARKS_SCHEMA)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(marks)
        .groupBy("digest")
        .agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("copies"))
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    spark.createDataFrame([], kept.schema).write.parquet(f"{target}/batch=-1")
    before = {key: spark.conf.get(key, None) for key in DISK_BACKED}
    for key, value in DISK_BACKED.items():
        spark.conf.set(key, value)
    try:
        writer = kept.writeStream.outputMode("update").option("checkpointLocation", log)
        writer.foreachBatch(land).trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    changes = spark.read.schema(kept.schema).parquet(target)
    return changes.groupBy("digest").agg(F.min("first").alias("first"), F.max("copies").alias("copies"))


def tag_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Stored rows ``(file, pos, doc_id, keep_id, group_size, kept, digest)``, one per row of ``docs``.

    Of rows with equal normalised text the one with the smallest id stays, rows without an id last; among rows with
    the same id, the one that comes first in the stored files. Null text counts as empty. An empty table gives an
    empty result. Other columns of ``docs`` take no part, whatever their names.
    """
    return _tag(located(docs), id_col, text_col, digest)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`tag_copies` does not keep; columns as they were."""
    source = located(docs)
    dropped = _tag(source, id_col, text_col, sha256).where(~F.col("kept")).select("file", "pos")
    return source.join(dropped, ["file", "pos"], "left_anti").select("row.*")


def _order() -> Column:
    """By what the row that stays comes first; rows without an id come last."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "pos").alias("first")


def _tag(source: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    spark = source.sparkSession
    require_columns(source.select("row.*"), [id_col, text_col])
    row = F.col("row")
    content = source.select(
        row[id_col].cast("long").alias("id"), "file", "pos", normalised(row[text_col]).alias("text")
    )
    stored = new_path(spark, "content-marks")
    content.select(digest(F.col("text")).alias("digest"), _order()).write.parquet(stored)

    marks = spark.read.schema(MARKS_SCHEMA).parquet(stored)
    own = marks.select("digest", F.col("first.id").alias("id"), F.col("first.file").alias("file"), "first.pos")
    tags = materialize(own.join(first_seen(spark, stored), "digest"), "copy-tags")

    kept = new_path(spark, "copies")
    with discarded(spark):  # the compared texts
        return written(_compared(tags, content), kept)


def _compared(tags: DataFrame, content: DataFrame) -> DataFrame:
    """:func:`tag_copies` of rows with their digest's first row and copies, of which equal digests may belie others.

    The full bytes of every row with a hit are compared with those of the retained row.
    """
    is_first = (F.col("file") == F.col("first.file")) & (F.col("pos") == F.col("first.pos"))
    hits = tags.where(F.col("copies") > 1).select("digest", "file", "pos", is_first.alias("is_first"))
    texts = materialize(content.join(hits, ["file", "pos"]), "copy-contents")
    retained = texts.where("is_first").select("digest", F.col("text").alias("kept_text"))
    others = texts.where("not is_first").join(retained, "digest").where(F.col("text") != F.col("kept_text"))
    odd = materialize(others.select("digest", "id", "file", "pos", "text"), "digest-collisions")
    regrouped = odd.groupBy("digest", "text").agg(F.min(_order()).alias("odd_first"), F.count(F.lit(1)).alias("odd_size"))
    odd_tags = odd.join(regrouped, ["digest", "text"]).select("file", "pos", "odd_first", "odd_size")
    lost = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))

    keeper = F.coalesce(F.col("odd_first"), F.col("first"))
    size = F.coalesce(F.col("odd_size"), F.col("copies") - F.coalesce(F.col("lost"), F.lit(0)))
    tagged = tags.join(odd_tags, ["file", "pos"], "left").join(lost, "digest", "left")
    return tagged.select(
        "file",
        "pos",
        F.col("id").alias("doc_id"),
        keeper["id"].alias("keep_id"),
        size.alias("group_size"),
        ((F.col("file") == keeper["file"]) & (F.col("pos") == keeper["pos"])).alias("kept"),
        "digest",
    )
