"""Score readings with a fitted pipeline, on batches and on streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.encoding import label_encode
from furrow.operators.features import CategorySlots, feature_columns
from furrow.schemas import CATEGORY_FEATURES

RAW = "raw"
ENCODED = "encoded"


def score_mode(model: PipelineModel) -> str:
    """``raw`` when the pipeline one-hot-encodes categories itself, else ``encoded``."""
    for stage in model.stages:
        nested = isinstance(stage, PipelineModel) and score_mode(stage) == RAW
        if nested or isinstance(stage, (CategorySlots, OneHotEncoderModel)):
            return RAW
    return ENCODED


def score(
    df: DataFrame, model: PipelineModel, dictionary: DataFrame | None = None, source: str = "reading"
) -> DataFrame:
    """Add ``needsIrrigation`` to every row; the input columns and rows are kept.

    A raw-mode model holds its own categories and takes no dictionary; an encoded-mode model needs one.
    """
    mode = score_mode(model)
    if mode == ENCODED and dictionary is None:
        raise ValueError("this model takes category codes: pass its dictionary")
    features = df.select(F.struct(*df.columns).alias("_row"), *feature_columns(df, source))
    if mode == ENCODED:
        features = label_encode(features, dictionary, CATEGORY_FEATURES)
    scored = model.transform(features)
    return scored.select("_row.*", F.col("prediction").cast("long").alias("needsIrrigation"))
