"""The one feature definition shared by training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import to_number
from furrow.functions.text import seedling_flag, strip
from furrow.operators.encoding import SLOT_SCHEMA, category_slots
from furrow.schemas import CATEGORY_FEATURES, LABEL, NUMERIC_FEATURES, require_columns

# Column of each feature in the two tables, in the order of the model contract.
FEATURE_SOURCES = {
    "reading": {
        "moi": "moisturePct",
        "temp": "tempC",
        "humidity": "humidity",
        "crop_id": "cropId",
        "soil_type": "soilType",
        "seedling_stage": "stage",
    },
    "crop": {
        "moi": "moi",
        "temp": "temp",
        "humidity": "humidity",
        "crop_id": "crop_id",
        "soil_type": "soil_type",
        "seedling_stage": "seedling_stage",
    },
}


def feature_columns(df: DataFrame, source: str, stage_as: str = "flag") -> list[Column]:
    """The six features as columns over a table of readings or crop rows.

    ``stage_as="flag"`` turns the stage into Yes/No for both tables, so that a model meets the same categories in
    training and in scoring; ``"text"`` keeps the stripped stage.
    """
    names = FEATURE_SOURCES[source]
    require_columns(df, list(names.values()))
    types = dict(df.dtypes)
    stage = seedling_flag if stage_as == "flag" else strip
    return [
        *[to_number(names[f], types[names[f]]).alias(f) for f in NUMERIC_FEATURES],
        strip(names["crop_id"]).alias("crop_id"),
        strip(names["soil_type"]).alias("soil_type"),
        stage(names["seedling_stage"]).alias("seedling_stage"),
    ]


def feature_projection(
    df: DataFrame, source: str, stage_as: str = "flag", keep: Sequence[str] = ()
) -> DataFrame:
    """The features in contract order, with the integer label of crop rows; ``keep`` lists columns to carry along."""
    label = [F.col(LABEL).cast("int").alias(LABEL)] if source == "crop" and LABEL in df.columns else []
    return df.select(*keep, *feature_columns(df, source, stage_as), *label)


class CategorySlots(Transformer, MLWritable, MLReadable):
    """Stage that gives each category its slot in a one-hot vector, in columns ``<column>_index``.

    It carries the table of :func:`furrow.operators.encoding.category_slots`, also when it is saved: a pipeline with
    this stage needs no dictionary beside it. Null and unseen categories take a further slot, the last, which the
    encoder after it drops. Joins carry no hint, as those with a dictionary.
    """

    def __init__(self, slots: DataFrame, sizes: dict[str, int]):
        super().__init__()
        self.slots, self.sizes = slots, sizes

    @classmethod
    def fitted(cls, dictionary: DataFrame, columns: Sequence[str] = CATEGORY_FEATURES) -> CategorySlots:
        slots = category_slots(dictionary, columns)
        found = dict(slots.groupBy("column").agg((F.max("slot") + 1).alias("size")).collect())
        return cls(slots, {c: found.get(c, 0) for c in columns})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, size in self.sizes.items():
            entries = self.slots.where(F.col("column") == c).select(F.col("category").alias(c), F.col("slot").alias(f"_{c}_slot"))
            nominal = {"ml_attr": {"type": "nominal", "name": f"{c}_index", "num_vals": size + 1}}
            slot = F.coalesce(F.col(f"_{c}_slot"), F.lit(size)).cast("double")
            joined = out.join(entries, c, "left")
            out = joined.select(*out.columns, slot.alias(f"{c}_index", metadata=nominal))
        return out

    def write(self) -> MLWriter:
        return _SlotsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SlotsReader()


class _SlotsWriter(MLWriter):
    def __init__(self, stage: CategorySlots):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        sizes = {"sizes": self.stage.sizes}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, sizes)
        self.stage.slots.write.parquet(f"{path}/slots")


class _SlotsReader(MLReader):
    def load(self, path: str) -> CategorySlots:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        slots = self.sparkSession.read.schema(SLOT_SCHEMA).parquet(f"{path}/slots")
        return CategorySlots(slots, metadata["sizes"])


def feature_stages(
    category_columns: Sequence[str] = CATEGORY_FEATURES,
    numeric_columns: Sequence[str] = NUMERIC_FEATURES,
    scale: bool = False,
    slots: CategorySlots | None = None,
) -> list[Estimator | Transformer]:
    """Stages from feature columns to the ``features`` vector: one-hot categories, then numbers.

    Unknown and null categories give an all-zero block. Missing numbers become the training median, because Spark's
    trees take no NaN. ``slots`` are the categories' known places, with rare ones in one; without them an indexer
    learns the categories from the data.
    """
    indexed = [f"{c}_index" for c in category_columns]
    encoded = [f"{c}_onehot" for c in category_columns]
    filled = [f"{c}_filled" for c in numeric_columns]
    assembled = "assembled" if scale else "features"
    indexer = slots or StringIndexer(
        inputCols=list(category_columns), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    stages = [
        indexer,
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        Imputer(inputCols=list(numeric_columns), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=[*encoded, *filled], outputCol=assembled),
    ]
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=True))
    return stages


def encoded_stages(
    category_columns: Sequence[str] = CATEGORY_FEATURES, numeric_columns: Sequence[str] = NUMERIC_FEATURES
) -> list[Estimator]:
    """Stages for dictionary-encoded categories: their indexes join the vector as numbers."""
    filled = [f"{c}_filled" for c in numeric_columns]
    return [
        Imputer(inputCols=list(numeric_columns), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=[*category_columns, *filled], outputCol="features"),
    ]


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from its ML metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name for _, name in slots]


def vector_blocks(model: PipelineModel) -> list[tuple[str, int, int]]:
    """``(feature, first slot, slots)`` of the vector that a fitted pipeline assembles, in order."""
    sizes = next((stage.sizes for stage in model.stages if isinstance(stage, CategorySlots)), {})
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    blocks, first = [], 0
    for name in assembler.getInputCols():
        variable = name.removesuffix("_onehot").removesuffix("_filled")
        size = sizes[variable] if name.endswith("_onehot") else 1
        blocks.append((variable, first, size))
        first += size
    return blocks


def hot_names(vectors: DataFrame, model: PipelineModel, keep: Sequence[str], row: str) -> DataFrame:
    """``row, keep..., hot`` of assembled vectors: ``<feature>_<category>`` of the slots that are 1, in vector order.

    A feature has at most one such slot, so its place in the vector is joined with the feature's stored slots: rows keep
    their place if those are few, and no place lists a vocabulary if they are not. ``row`` is a column that tells rows
    apart; a row without such slots has an empty ``hot``.
    """
    slots = next(stage for stage in model.stages if isinstance(stage, CategorySlots))
    blocks = {variable: (first, size) for variable, first, size in vector_blocks(model) if variable in slots.sizes}
    vector = F.unwrap_udt("features")
    places = F.when(vector["type"] == 0, vector["indices"]).otherwise(F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    held = F.filter(F.arrays_zip(places.alias("place"), vector["values"].alias("value")), lambda e: e["value"] != 0)
    out = vectors.select(row, *keep, F.transform(held, lambda e: e["place"]).alias("_places"))
    for c, (first, size) in blocks.items():
        own = F.filter("_places", lambda p: (p >= first) & (p < first + size))  # noqa: B023
        names = slots.slots.where(F.col("column") == c)
        names = names.select(F.col("slot").alias("_slot"), F.concat_ws("_", "column", "slot_name").alias(f"_{c}_name")).distinct()
        placed = out.withColumn("_at", (F.get(own, 0) - first).cast("long"))
        out = placed.join(names, F.col("_at") == F.col("_slot"), "left").drop("_at", "_slot")
    return out.select(row, *keep, F.concat_ws(" ", *[f"_{c}_name" for c in blocks]).alias("hot"))


def standardize(df: DataFrame, fit_on: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Shift and scale numeric columns to zero mean and unit population variance of ``fit_on``, in place.

    The statistics are one row. A constant column is only shifted.
    """
    stats = fit_on.agg(
        *[F.avg(c).alias(f"_{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"_{c}_std") for c in columns]
    )

    def scaled(c: str) -> Column:
        std = F.when(F.col(f"_{c}_std") == 0, F.lit(1.0)).otherwise(F.col(f"_{c}_std"))
        return (F.col(c) - F.col(f"_{c}_mean")) / std

    return df.crossJoin(F.broadcast(stats)).withColumns({c: scaled(c) for c in columns}).select(*df.columns)
