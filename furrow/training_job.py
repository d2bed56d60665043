"""``python -m furrow.training_job``: profile a crop table, compare classifiers, export the best one.

The model and its dictionary land where the scoring stream loads them; every figure is written as a small table.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators import metrics, profiling, quality, sampling
from furrow.operators import training as ml
from furrow.operators.features import feature_projection
from furrow.schemas import CATEGORY_FEATURES
from furrow.session import build_session
from furrow.sources.artefacts import save_dictionary, save_model
from furrow.sources.crop_table import read_crop_csv
from furrow.workspace import materialize


@dataclass(frozen=True)
class TrainingConfig:
    """``refit_on="train"`` keeps the hold-out rows unseen; ``"all"`` compares and refits on every row."""

    csv_path: str
    model_path: str = "models/pipeline"
    dictionary_path: str = "models/dictionary"
    report_path: str = "models/report"
    profile: str = "reference"
    refit_on: str = "train"
    folds: int = 5
    holdout: float = 0.2
    with_network: bool = True

    def __post_init__(self) -> None:
        if self.refit_on not in ("train", "all"):
            raise ValueError(f"refit_on is train or all, not {self.refit_on!r}")


def profile_reports(raw: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """Figures of the table as delivered and after cleaning."""
    trimmed = quality.trim_categories(raw)
    deduped = quality.dedupe_rows(trimmed)
    bounds = profiling.iqr_bounds(cleaned)
    flags = profiling.outlier_flags(cleaned, bounds)
    reports = {
        "table_profile": quality.table_profile(raw),
        "category_cardinality": quality.category_cardinality(raw, CATEGORY_FEATURES),
        "top_categories": profiling.top_categories(raw, CATEGORY_FEATURES),
        "null_profile": quality.null_profile(raw),
        "duplicate_count": quality.duplicate_count(trimmed),
        "label_distribution_raw": quality.label_distribution(deduped),
        "invalid_label_count": quality.invalid_label_count(deduped),
        "label_distribution": quality.label_distribution(cleaned),
        "boxplot_stats": profiling.boxplot_stats(cleaned),
        "iqr_bounds": bounds,
        "outlier_counts": profiling.outlier_counts(flags),
        "outlier_rows": profiling.outlier_union(flags).agg(F.count(F.lit(1)).alias("rows")),
        "class_weights": metrics.class_weights(cleaned),
    }
    for c in CATEGORY_FEATURES:
        reports[f"crosstab_{c}"] = profiling.crosstab(cleaned, c)
    return reports


def holdout_reports(scored: DataFrame, prefix: str) -> dict[str, DataFrame]:
    return {
        f"{prefix}_confusion_matrix": metrics.confusion_matrix(scored),
        f"{prefix}_classification_report": metrics.classification_report(scored),
        f"{prefix}_roc_auc": metrics.roc_auc(scored),
    }


def run_training(spark: SparkSession, cfg: TrainingConfig) -> str:
    """Run the whole job; returns the name of the exported candidate."""
    # Parsed once: the figures below read columns, not text.
    raw = materialize(read_crop_csv(spark, cfg.csv_path), "raw")
    cleaned = materialize(quality.clean_crop(raw), "cleaned")
    quality.assert_label_domain(cleaned)
    reports = profile_reports(raw, cleaned)

    split = materialize(sampling.stratified_split(cleaned, fraction=cfg.holdout), "split")
    reports["label_share"] = quality.label_share(split, by="split")
    features = {
        part: feature_projection(split.where(F.col("split") == part), "crop") for part in ("train", "valid")
    }
    everything = feature_projection(cleaned, "crop")
    fitted_on = features["train"] if cfg.refit_on == "train" else everything

    estimators = ml.candidates(cfg.profile)
    # Folds are drawn from whole rows, before the projection folds several stages into one flag.
    rows = cleaned if cfg.refit_on == "all" else split.where(F.col("split") == "train").drop("split")
    folded = feature_projection(sampling.stratified_folds(rows, k=cfg.folds), "crop", keep=["fold"])
    fold_metrics = ml.cross_validate(estimators, folded)
    reports["fold_metrics"] = fold_metrics
    reports["cv_summary"] = metrics.cv_summary(fold_metrics)

    name, model, dictionary = ml.fit_best(estimators, fold_metrics, fitted_on)
    scored = materialize(ml.predict(features["valid"], model, dictionary), "scored")
    reports |= holdout_reports(scored, "best")
    reports["variable_importance"] = ml.variable_importance(model)
    if cfg.with_network:
        net, net_dictionary = ml.train_network(features["train"], cfg.profile)
        net_scored = materialize(ml.predict(features["valid"], net, net_dictionary), "scored")
        reports |= holdout_reports(net_scored, "network")

    save_model(model, cfg.model_path)
    save_dictionary(dictionary, cfg.dictionary_path)
    for report, table in reports.items():
        table.write.mode("overwrite").parquet(f"{cfg.report_path}/{report}")
    return name


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True)
    parser.add_argument("--model", default=TrainingConfig.model_path)
    parser.add_argument("--dictionary", default=TrainingConfig.dictionary_path)
    parser.add_argument("--report", default=TrainingConfig.report_path)
    parser.add_argument("--profile", choices=sorted(ml.ROUNDS), default=TrainingConfig.profile)
    parser.add_argument("--refit-on", choices=["train", "all"], default=TrainingConfig.refit_on)
    parser.add_argument("--no-network", action="store_true")
    args = parser.parse_args(argv)
    cfg = TrainingConfig(
        csv_path=args.csv,
        model_path=args.model,
        dictionary_path=args.dictionary,
        report_path=args.report,
        profile=args.profile,
        refit_on=args.refit_on,
        with_network=not args.no_network,
    )
    spark = build_session("furrow-training")
    print(run_training(spark, cfg))
    for report in ("cv_summary", "best_classification_report", "variable_importance"):
        spark.read.parquet(f"{cfg.report_path}/{report}").show(truncate=False)


if __name__ == "__main__":
    main()
