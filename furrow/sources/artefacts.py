"""Fitted models and category dictionaries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from furrow.operators.encoding import DICTIONARY_SCHEMA


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a pipeline; raises before any stream starts when it cannot be read."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise RuntimeError(f"cannot load the model at {path}: {error}") from error


def save_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").parquet(path)


def load_dictionary(spark: SparkSession, path: str, required: bool = True) -> DataFrame | None:
    """The saved dictionary; ``None`` when it is absent and not required."""
    try:
        return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if required:
            raise RuntimeError(f"the model needs a category dictionary at {path}: {error}") from error
        return None
