"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written and read again before the next, so a
stage starts from files. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from furrow.llm import stages
from furrow.workspace import materialize

STAGES = [
    ("language", lambda spark, docs, sf_dir: stages.keep_languages(docs)),
    ("exact copies", lambda spark, docs, sf_dir: stages.drop_exact_copies(docs)),
    ("near copies", lambda spark, docs, sf_dir: stages.drop_near_copies(docs)),
    ("repeated passages", lambda spark, docs, sf_dir: stages.cut_repeats(docs)),
    ("packing", lambda spark, docs, sf_dir: stages.pack(docs)),
]

# A language model, a tokenizer and bin packing are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the workspace and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
