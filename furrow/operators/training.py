"""Candidate classifiers, cross-validation, selection and explanation."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import copy_context
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators.encoding import fit_dictionary, label_encode
from furrow.operators.features import CategorySlots, encoded_stages, feature_stages, vector_blocks
from furrow.operators.metrics import (
    best_model,
    binary_metrics,
    classification_report,
    cv_summary,
    roc_auc,
    threshold_class,
    with_class_weight,
)
from furrow.operators.network import LAYERS, Network
from furrow.operators.scoring import RAW
from furrow.operators.trees import ROWS_TO_FIT, Boosting, Forest, ForestModel, Growth
from furrow.schemas import CATEGORY_FEATURES, LABEL
from furrow.workspace import discarded, materialize

SEED = 42
FOLD_METRICS_SCHEMA = "model string, fold int, f1 double, precision double, recall double, roc_auc double"

ROWS_PER_PART = 100_000

# Trees per candidate of the full job; "smoke" has small ones for tests.
ROUNDS = {
    "reference": {
        "gbt_deep": 800,
        "gbt_wide": 400,
        "random_forest": 500,
        "extra_trees": 700,
        "gbt_classic": 500,
    },
    "smoke": {
        "gbt_deep": 5,
        "gbt_wide": 5,
        "random_forest": 8,
        "extra_trees": 8,
        "gbt_classic": 5,
    },
}


def candidates(profile: str = "reference", rows_to_fit: int | None = ROWS_TO_FIT) -> dict[str, Estimator]:
    """The five tree ensembles by name, each fitted on at most about ``rows_to_fit`` labelled rows, or on all with ``None``.

    ``gbt_deep`` has gains of second order with an L2 term and draws features per tree; ``gbt_wide`` grows its best leaf
    first up to a number of leaves; ``gbt_classic`` splits by residuals. Forests weight the classes alike and grow to the
    end. Spark ML's own learners are in :func:`whole_table_candidates`.
    """
    rounds, common = ROUNDS[profile], {"rows_to_fit": rows_to_fit, "seed": SEED}
    return {
        "gbt_deep": Boosting(
            **common,
            rounds=rounds["gbt_deep"],
            rate=0.05,
            row_share=0.9,
            column_share=0.9,
            from_prior=False,
            growth=Growth(depth=6, l2=1.0, least_hessian=1.0),
        ),
        "gbt_wide": Boosting(**common, rounds=rounds["gbt_wide"], rate=0.08, growth=Growth(leaves=31, least_rows=20)),
        "random_forest": Forest(**common, trees=rounds["random_forest"]),
        "extra_trees": Forest(**common, trees=rounds["extra_trees"], bootstrap=False, random_cuts=True),
        "gbt_classic": Boosting(
            **common, rounds=rounds["gbt_classic"], rate=0.05, row_share=0.9, growth=Growth(depth=3, by_residuals=True)
        ),
    }


def whole_table_candidates(profile: str = "reference") -> dict[str, Estimator]:
    """Spark ML's learners in their place, which read all rows, however many.

    They grow trees level by level, to a depth of 30 at most, boost without an L2 term, and have no random cuts.
    """
    rounds = ROUNDS[profile]
    # More histogram memory lets a pass over the rows split more nodes.
    common = {"featuresCol": "features", "labelCol": LABEL, "seed": SEED, "maxMemoryInMB": 1024}
    rates = {"gbt_deep": (0.05, 0.9, 6, 256), "gbt_wide": (0.08, 1.0, 5, 256), "gbt_classic": (0.05, 0.9, 3, 32)}
    found: dict[str, Estimator] = {
        name: GBTClassifier(
            **common, maxIter=rounds[name], stepSize=rate, subsamplingRate=share, maxDepth=depth, maxBins=bins
        )
        for name, (rate, share, depth, bins) in rates.items()
    }
    depth = {"reference": 30, "smoke": 8}[profile]
    forest = RandomForestClassifier(**common, numTrees=rounds["random_forest"], maxDepth=depth, weightCol="weight")
    return found | {"random_forest": forest}


def network(profile: str = "reference", rows_to_fit: int = ROWS_TO_FIT) -> Network:
    """Feed-forward network with hidden layers of 64, 32 and 16 units, a fifth of which drop out in training."""
    passes = {"reference": 30, "smoke": 10}[profile]
    return Network(layers=LAYERS, dropout=0.2, passes=passes, batch=32, patience=10, rows_to_fit=rows_to_fit, seed=SEED)


@dataclass
class Prepared:
    """Training rows with assembled features, and what scoring needs to assemble them the same way."""

    rows: DataFrame
    stages: PipelineModel
    dictionary: DataFrame


def prepare(train: DataFrame, mode: str = RAW, scale: bool = False) -> Prepared:
    """Fit the dictionary and the feature stages on ``train`` (a feature projection) and assemble its vectors once.

    The assembled rows are written to the workspace: every round of every candidate reads them.
    """
    dictionary = fit_dictionary(train, CATEGORY_FEATURES)
    weighted = with_class_weight(train, LABEL)
    if mode == RAW:
        slots = CategorySlots.fitted(dictionary)
        stages = Pipeline(stages=feature_stages(scale=scale, slots=slots)).fit(weighted)
    else:
        weighted = label_encode(weighted, dictionary, CATEGORY_FEATURES)
        stages = Pipeline(stages=encoded_stages()).fit(weighted)
    # The vector's size, without a name for every slot: tasks and files carry what a column's metadata holds.
    _, first, size = vector_blocks(stages)[-1]
    features = F.col("features").alias("features", metadata={"ml_attr": {"num_attrs": first + size}})
    rows = stages.transform(weighted).select(features, LABEL, "weight")
    return Prepared(_evenly(rows), stages, dictionary)


def _evenly(rows: DataFrame) -> DataFrame:
    """Rows written in few, even parts: every round of a learner runs a task per part."""
    stored = materialize(rows, "assembled")
    parts = max(1, -(-stored.count() // ROWS_PER_PART))
    return stored.coalesce(parts) if parts < stored.rdd.getNumPartitions() else stored


def fit_on(prepared: Prepared, estimator: Estimator) -> PipelineModel:
    """Fit one classifier on prepared rows; the result holds the feature stages too."""
    return PipelineModel(stages=[*prepared.stages.stages, estimator.fit(prepared.rows)])


def train(
    features: DataFrame, estimator: Estimator, mode: str = RAW
) -> tuple[PipelineModel, DataFrame]:
    """Fitted pipeline and category dictionary for one classifier."""
    prepared = prepare(features, mode)
    return fit_on(prepared, estimator), prepared.dictionary


def train_network(features: DataFrame, profile: str = "reference") -> tuple[PipelineModel, DataFrame]:
    """Fitted network on scaled features and its dictionary."""
    prepared = prepare(features, RAW, scale=True)
    return fit_on(prepared, network(profile)), prepared.dictionary


def assembled(
    features: DataFrame, model: PipelineModel, dictionary: DataFrame, mode: str = RAW
) -> DataFrame:
    """Feature rows as the model sees and scores them."""
    if mode != RAW:
        features = label_encode(features, dictionary, CATEGORY_FEATURES)
    return model.transform(features)


def predict(features: DataFrame, model: PipelineModel, dictionary: DataFrame, mode: str = RAW) -> DataFrame:
    """Label, probability of class 1 and the class at threshold 0.5, for labelled feature rows."""
    score = vector_to_array("probability")[1]
    return assembled(features, model, dictionary, mode).select(LABEL, score.alias("score")).withColumn("prediction", threshold_class(F.col("score")))


def score_metrics(scored: DataFrame) -> DataFrame:
    """One row with F1, precision, recall and ROC-AUC of a scored table."""
    return binary_metrics(scored).crossJoin(roc_auc(scored)).select("f1", "precision", "recall", "roc_auc")


def cross_validate(
    estimators: dict[str, Estimator], folded: DataFrame, parallelism: int = 5, folds_at_once: int = 2
) -> DataFrame:
    """Metrics per model and fold: rows ``(model, fold, f1, precision, recall, roc_auc)``.

    ``folded`` is a feature projection with a ``fold`` column. Dictionary and feature stages are fitted on the
    training part of each fold and shared by the candidates, of which ``parallelism`` are fitted at a time, for
    ``folds_at_once`` folds. The driver receives one metrics row per fit. A fold's tables are deleted when it is done.
    """
    spark = folded.sparkSession

    def check_fold(folded: DataFrame, fold: int) -> list[tuple]:
        with discarded(spark), ThreadPool(min(parallelism, len(estimators))) as pool:
            prepared = prepare(folded.where(F.col("fold") != fold).drop("fold"))
            held_out = folded.where(F.col("fold") == fold)

            def check(name: str) -> tuple:
                model = fit_on(prepared, estimators[name])
                scored = materialize(predict(held_out, model, prepared.dictionary), "scored")
                return (name, int(fold), *score_metrics(scored).first())

            return _in_threads(spark, pool, check, list(estimators))

    with discarded(spark), ThreadPool(folds_at_once) as pool:
        folded = materialize(folded, "folds")
        folds = sorted(row["fold"] for row in folded.select("fold").distinct().collect())
        results = _in_threads(spark, pool, lambda fold: check_fold(folded, fold), folds)
    return spark.createDataFrame([row for rows in results for row in rows], FOLD_METRICS_SCHEMA)


def _in_threads(spark: SparkSession, pool: ThreadPool, run: Callable, items: list) -> list:
    """Results of ``run`` on every item, in threads that share this one's job properties and context."""
    run = inheritable_thread_target(spark)(run)
    return pool.starmap(lambda context, item: context.run(run, item), [(copy_context(), item) for item in items])


def fit_best(
    estimators: dict[str, Estimator],
    fold_metrics: DataFrame,
    rows: DataFrame,
    metric: str = "f1",
) -> tuple[str, PipelineModel, DataFrame]:
    """Name, fitted pipeline and dictionary of the candidate with the best mean metric.

    ``rows`` decides what the winner is refitted on: the training part for an honest hold-out check, or all rows for
    the model that is shipped.
    """
    name = best_model(cv_summary(fold_metrics), metric).first()["model"]
    model, dictionary = train(rows, estimators[name])
    return name, model, dictionary


def evaluate_holdout(model: PipelineModel, dictionary: DataFrame, valid: DataFrame, mode: str = RAW) -> DataFrame:
    """Classification report on rows the model has not seen."""
    return classification_report(predict(valid, model, dictionary, mode))


def variable_importance(model: PipelineModel) -> DataFrame:
    """Rows ``(variable, importance)``: slot importances of a tree model summed per feature, highest first.

    Slots that a tree splits by meet the few blocks that the features have in the vector; no vocabulary is listed.
    """
    fitted, blocks = model.stages[-1], vector_blocks(model)
    spark = SparkSession.active()
    if isinstance(fitted, ForestModel):
        slots = fitted.importances()
    else:
        vector = fitted.featureImportances
        slots = spark.createDataFrame(zip(vector.indices.tolist(), vector.values.tolist()), "slot int, importance double")
    # A row per feature.
    table = F.broadcast(spark.createDataFrame(blocks, "variable string, first int, size int"))
    inside = (F.col("slot") >= F.col("first")) & (F.col("slot") < F.col("first") + F.col("size"))
    summed = slots.join(table, inside).groupBy("variable").agg(F.sum("importance").alias("importance"))
    variables = table.select("variable").join(summed, "variable", "left")
    return variables.select("variable", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(
        F.desc("importance"), "variable"
    )
