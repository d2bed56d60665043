"""Classification metrics from scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.schemas import LABEL, LABEL_DOMAIN
from furrow.workspace import materialize

ROWS_PER_RANGE = 1_000_000


def threshold_class(score, threshold: float = 0.5):
    """1 when the score reaches the threshold, else 0."""
    return (score >= F.lit(threshold)).cast("int")


def _cells(df: DataFrame, label: str, pred: str, domain: Sequence[int]) -> DataFrame:
    """One row with a count ``n_<actual>_<predicted>`` per pair of the domain."""
    return df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(pred) == p)).alias(f"n_{a}_{p}")
            for a in domain
            for p in domain
        ]
    )


def _ratio(part, whole):
    """part / whole, 0 when there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _class_figures(c: int, domain: Sequence[int]):
    hits = F.col(f"n_{c}_{c}")
    predicted = sum((F.col(f"n_{a}_{c}") for a in domain), F.lit(0))
    support = sum((F.col(f"n_{c}_{p}") for p in domain), F.lit(0))
    return _ratio(hits, predicted), _ratio(hits, support), _ratio(2 * hits, predicted + support), support


def confusion_matrix(
    df: DataFrame, label: str = LABEL, pred: str = "prediction", domain: Sequence[int] = LABEL_DOMAIN
) -> DataFrame:
    """Rows ``(actual, predicted, rows)`` for every pair of the domain, zeros kept."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n_{a}_{p}").alias("rows"))
            for a in domain
            for p in domain
        ]
    )
    return _cells(df, label, pred, domain).select(F.inline(cells))


def binary_metrics(df: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    """One row: precision, recall and F1 of class 1."""
    precision, recall, f1, _ = _class_figures(1, LABEL_DOMAIN)
    cells = _cells(df, label, pred, LABEL_DOMAIN)
    return cells.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def classification_report(
    df: DataFrame,
    label: str = LABEL,
    pred: str = "prediction",
    domain: Sequence[int] = LABEL_DOMAIN,
    digits: int = 4,
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the macro and weighted averages."""
    figures = [_class_figures(c, domain) for c in domain]
    total = sum((f[3] for f in figures), F.lit(0))
    hits = sum((F.col(f"n_{c}_{c}") for c in domain), F.lit(0))

    def row(name, precision, recall, f1, support):
        def shown(x):
            return F.round(x, digits) if x is not None else F.lit(None).cast("double")

        return F.struct(
            F.lit(name).alias("class"),
            shown(precision).alias("precision"),
            shown(recall).alias("recall"),
            shown(f1).alias("f1"),
            support.alias("support"),
        )

    def macro(i):
        return sum((f[i] for f in figures), F.lit(0.0)) / len(domain)

    def weighted(i):
        return _ratio(sum((f[i] * f[3] for f in figures), F.lit(0.0)), total)

    rows = [row(str(c), *f) for c, f in zip(domain, figures)]
    rows.append(row("accuracy", None, None, _ratio(hits, total), total))
    rows.append(row("macro avg", macro(0), macro(1), macro(2), total))
    rows.append(row("weighted avg", weighted(0), weighted(1), weighted(2), total))
    return _cells(df, label, pred, domain).select(F.inline(F.array(*rows)))


def roc_auc(df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """One row ``roc_auc``: the exact area under the ROC curve, ties averaged; null without both classes.

    The area is the share of (positive, negative) pairs in the right order. It needs, per distinct score, the
    negatives below it: those in lower ranges of scores, plus those below inside the range. The distinct scores are
    counted and then sorted into ranges, as many as ``ROWS_PER_RANGE`` asks for, which are stored; a task ranks one.
    """
    rows = df.where(F.col(score).isNotNull()).select(
        F.col(score).cast("double").alias("s"),
        (F.col(label) == 1).cast("long").alias("pos"),
        (F.col(label) == 0).cast("long").alias("neg"),
    )
    scores = materialize(rows.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "scores")
    ranges = max(1, -(-scores.count() // ROWS_PER_RANGE))
    sorted_scores = scores.repartitionByRange(ranges, "s").withColumn("range", F.spark_partition_id())
    ranged = materialize(sorted_scores, "score-ranges")

    # One row per range.
    totals = ranged.groupBy("range").agg(F.sum("neg").alias("neg"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range", F.coalesce(F.sum("neg").over(earlier), F.lit(0)).alias("offset"))

    inside = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    below = F.col("offset") + F.col("inside")
    pairs = F.col("pos").cast("double") * (below + F.col("neg") / F.lit(2.0))
    sums = placed.join(offsets, "range").agg(
        F.sum(pairs).alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    all_pairs = F.col("pos").cast("double") * F.col("neg")
    return sums.select(F.when(all_pairs > 0, F.col("pairs") / all_pairs).alias("roc_auc"))


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean of each metric over the folds, per model."""
    return fold_metrics.groupBy("model").agg(
        *[F.avg(m).alias(m) for m in ("f1", "precision", "recall", "roc_auc")],
        F.count(F.lit(1)).alias("folds"),
    )


def best_model(summary: DataFrame, metric: str = "f1") -> DataFrame:
    """The top row by one metric; equal models by name."""
    return summary.orderBy(F.desc_nulls_last(metric), "model").limit(1)


def with_class_weight(
    df: DataFrame, label: str = LABEL, labels: Sequence[int] = LABEL_DOMAIN, weight: str = "weight"
) -> DataFrame:
    """Add balanced weights, rows / (classes * rows of the class), from a one-row table of class counts.

    Classes without rows do not count; a row whose label is not in ``labels`` gets no weight.
    """
    counts = class_weights(df, label, labels)
    row = counts.agg(*[F.max(F.when(F.col(label) == v, F.col(weight))).alias(f"_w{v}") for v in labels])
    chosen = F.coalesce(*[F.when(F.col(label) == v, F.col(f"_w{v}")) for v in labels])
    return df.crossJoin(F.broadcast(row)).select(*df.columns, chosen.alias(weight))


def class_weights(df: DataFrame, label: str = LABEL, labels: Sequence[int] = LABEL_DOMAIN) -> DataFrame:
    """Rows ``(label, rows, weight)``."""
    counts = df.where(F.col(label).isin(*labels)).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(F.sum("rows").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(totals)).select(
        label, "rows", (F.col("_n") / (F.col("_k") * F.col("rows"))).alias("weight")
    )
