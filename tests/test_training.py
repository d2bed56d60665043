"""Models: contract, quality bounds, round trips, selection."""

from __future__ import annotations

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators import encoding, sampling
from furrow.operators import training as ml
from furrow.operators import trees
from furrow.operators.encoding import fit_dictionary
from furrow.operators.features import CategorySlots, feature_projection, feature_stages, hot_names, vector_names
from furrow.operators.metrics import best_model, cv_summary
from furrow.operators.quality import clean_crop
from furrow.operators.readings import clean_readings
from furrow.operators.scoring import ENCODED, RAW, score, score_mode
from furrow.operators.trees import Forest
from furrow.plans import queries
from furrow.plans.bindings import crop, read_table, rule_model, sensor_envelope
from furrow.plans.oracles import ORACLES
from furrow.schemas import CATEGORY_FEATURES, FEATURES, LABEL
from furrow.sources.artefacts import load_dictionary, load_model, save_dictionary, save_model
from furrow.sources.crop_table import write_crop_csv
from furrow.training_job import TrainingConfig, run_training
from furrow.workspace import materialize, workspace_root
from tests.conftest import DATA


@pytest.fixture(scope="module")
def features(spark):
    return materialize(feature_projection(clean_crop(crop(spark, DATA)), "crop"), "features")


@pytest.fixture(scope="module")
def forest(features):
    return ml.train(features, ml.candidates("smoke")["random_forest"])


@pytest.fixture(scope="module")
def clean(spark):
    return clean_readings(sensor_envelope(read_table(spark, DATA, "events")))


def test_reference_sizes(spark):
    models = ml.candidates("reference")
    deep, wide, classic = (models[n] for n in ("gbt_deep", "gbt_wide", "gbt_classic"))
    assert (deep.rounds, deep.rate, deep.row_share, deep.column_share) == (800, 0.05, 0.9, 0.9)
    assert (deep.growth.depth, deep.growth.l2) == (6, 1.0)
    assert (wide.rounds, wide.rate, wide.growth.depth, wide.growth.leaves) == (400, 0.08, None, 31)
    assert (classic.rounds, classic.rate, classic.row_share, classic.growth.depth) == (500, 0.05, 0.9, 3)
    forest, extra = models["random_forest"], models["extra_trees"]
    assert (forest.trees, forest.bootstrap, forest.random_cuts) == (500, True, False)
    assert (extra.trees, extra.bootstrap, extra.random_cuts) == (700, False, True)
    net = ml.network()
    assert (net.layers, net.dropout, net.passes, net.batch, net.patience) == ((64, 32, 16), 0.2, 30, 32, 10)
    assert {m.rows_to_fit for m in (*models.values(), net)} == {20_000}
    spark_models = ml.whole_table_candidates("reference")
    assert spark_models["gbt_deep"].getMaxIter() == 800 and spark_models["gbt_deep"].getMaxDepth() == 6
    assert spark_models["random_forest"].getNumTrees() == 500 and spark_models["random_forest"].getWeightCol() == "weight"


def test_learners_of_whole_tables(features):
    model, dictionary = ml.train(features, ml.whole_table_candidates("smoke")["gbt_wide"])
    assert ml.predict(features, model, dictionary).count() == features.count()
    assert ml.variable_importance(model).first()["variable"] == "moi"


def test_unknown_and_null_categories_are_zero(spark):
    train = spark.createDataFrame(
        [("a", "x", "Yes", 1.0, 2.0, 3.0), ("b", "y", "No", 4.0, None, 6.0), ("b", "y", "No", 5.0, 9.0, 6.0)],
        "crop_id string, soil_type string, seedling_stage string, moi double, temp double, humidity double",
    )
    fitted = Pipeline(stages=feature_stages()).fit(train)
    new = spark.createDataFrame([("z", None, "Yes", None, 1.0, 1.0)], train.schema)
    out = fitted.transform(new)
    slots = dict(zip(vector_names(out), out.select(vector_to_array("features")).first()[0]))
    on = {name for name, value in slots.items() if value and not name.endswith("_filled")}
    assert on == {"seedling_stage_onehot_Yes"}
    assert slots["moi_filled"] == 4.0
    assert vector_names(out)[-3:] == ["moi_filled", "temp_filled", "humidity_filled"]


def test_score_keeps_rows_and_columns(clean, forest):
    model, dictionary = forest
    scored = score(clean, model, dictionary)
    assert scored.columns == [*clean.columns, "needsIrrigation"]
    assert scored.drop("needsIrrigation").exceptAll(clean).count() == 0
    assert scored.count() == clean.count()
    assert {r[0] for r in scored.select("needsIrrigation").distinct().collect()} == {0, 1}


def test_modes(features, forest, clean):
    model, dictionary = forest
    assert score_mode(model) == RAW
    assert score(clean, model).count() == clean.count()
    encoded, codes = ml.train(features, ml.candidates("smoke")["gbt_classic"], ENCODED)
    assert score_mode(encoded) == ENCODED
    with pytest.raises(ValueError, match="dictionary"):
        score(clean, encoded)
    assert score(clean, encoded, codes).where("needsIrrigation NOT IN (0, 1)").count() == 0


def test_round_trip(spark, forest, clean, path):
    model, dictionary = forest
    save_model(model, path("m"))
    save_dictionary(dictionary, path("d"))
    again = score(clean, load_model(path("m")), load_dictionary(spark, path("d")))
    assert again.exceptAll(score(clean, model, dictionary)).count() == 0


def vectors(df):
    return sorted(r[0] for r in df.select(F.to_json(vector_to_array("features"))).collect())


def test_slots_give_the_vectors_of_an_indexer(spark, features):
    dictionary = fit_dictionary(features, CATEGORY_FEATURES)
    mapped = encoding.bucket_rare(features, dictionary, CATEGORY_FEATURES)
    found = Pipeline(stages=feature_stages()).fit(mapped).transform(mapped)
    slots = CategorySlots.fitted(dictionary)
    known = Pipeline(stages=feature_stages(slots=slots)).fit(features).transform(features)
    assert vectors(known) == vectors(found)


@pytest.fixture(scope="module")
def rare_features(spark):
    rows = feature_projection(clean_crop(crop(spark, DATA, "rare")), "crop")
    return materialize(rows, "rare-features")


def test_a_saved_model_needs_no_dictionary_for_rare_categories(spark, rare_features, path):
    model, dictionary = ml.train(rare_features, ml.candidates("smoke")["gbt_classic"])
    save_model(model, path("m"))
    unseen = rare_features.limit(1).withColumn("soil_type", F.lit("never seen"))
    nothing = rare_features.limit(1).withColumn("soil_type", F.lit(None).cast("string"))
    rows = rare_features.where("soil_type LIKE 'rare%'").unionByName(unseen).unionByName(nothing)
    assert rows.count() > 10
    before, after = model.transform(rows), load_model(path("m")).transform(rows)
    assert vectors(before) == vectors(after)
    names = vector_names(before)
    (slot,) = {r[0] for r in model.stages[0].slots.where("slot_name = '__rare__'").select("slot").collect()}
    hot = [dict(zip(names, r[0]))[f"soil_type_onehot_{slot}"] for r in before.select(vector_to_array("features")).collect()]
    soils = [r["soil_type"] for r in before.select("soil_type").collect()]
    kept = {r["category"] for r in dictionary.where("column = 'soil_type' AND rows >= 5").collect()}
    assert hot == [float(bool(s) and s.startswith("rare") and s not in kept) for s in soils] and 1.0 in hot
    with_dictionary, without = (score(clean_like(rows), model, d) for d in (dictionary, None))
    assert with_dictionary.exceptAll(without).count() == 0


def clean_like(rows):
    """Feature rows under the names of readings."""
    return rows.selectExpr(
        "moi AS moisturePct", "temp AS tempC", "humidity", "crop_id AS cropId", "soil_type AS soilType",
        "seedling_stage AS stage",
    )


def test_a_large_vocabulary_trains(spark, path):
    """More categories than any single place is asked to list."""
    n = 120_000
    rows = spark.range(5 * n).select(
        F.concat(F.lit("crop"), F.col("id") % n).alias("crop_id"), F.lit("s").alias("soil_type"), F.lit("No").alias("seedling_stage"),
        (F.col("id") % 100).cast("double").alias("moi"), F.lit(1.0).alias("temp"), F.lit(2.0).alias("humidity"),
        (F.col("id") % 100 < 50).cast("int").alias(LABEL),
    )
    prepared = ml.prepare(rows)
    assert prepared.rows.first()["features"].size == n + 1 + 1 + 3
    fitted = ml.fit_on(prepared, LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=2))
    assert fitted.transform(rows.limit(10)).where("prediction IN (0, 1)").count() == 10


def test_names_and_importances_of_a_large_vocabulary(spark, monkeypatch):
    """200,000 categories: neither the names of a row's slots nor the importances need them in one place."""
    n = 200_000
    rows = spark.range(5 * n).select(
        F.col("id").alias("row"), F.concat(F.lit("crop"), F.col("id") % n).alias("crop_id"), F.lit("s").alias("soil_type"),
        F.lit("No").alias("seedling_stage"), (F.col("id") % 100).cast("double").alias("moi"), F.lit(1.0).alias("temp"),
        F.lit(2.0).alias("humidity"), (F.col("id") % 100 < 50).cast("int").alias(LABEL),
    )
    prepared = ml.prepare(rows)
    model = ml.fit_on(prepared, Forest(trees=3, rows_to_fit=2_000))
    found = {r["variable"]: r["importance"] for r in ml.variable_importance(model).collect()}
    assert sorted(found) == sorted(FEATURES) and sum(found.values()) == pytest.approx(1) and found["moi"] > 0.5
    assert model.stages[-1].importances().count() < 3_000  # only slots that a tree splits by
    some = rows.where(F.col("row") % 1000 == 7)
    plans = []
    keep = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: plans.append(df.columns) or keep(df))
    named = hot_names(prepared.stages.transform(some), prepared.stages, ["crop_id"], "row")
    assert not plans
    for r in named.collect():
        assert r["hot"] == f"crop_id_{r['crop_id']} soil_type_s seedling_stage_No"
    assert named.count() == n // 200


def test_class_weights_are_counted_before_the_joins(features, monkeypatch):
    plans, keep = [], ml.with_class_weight
    monkeypatch.setattr(ml, "with_class_weight", lambda df, label: plans.append(df.columns) or keep(df, label))
    ml.prepare(features)
    assert plans == [features.columns]


def test_folds_leave_no_tables(spark, features):
    folded = sampling.stratified_folds(features)
    root = workspace_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    figures = ml.cross_validate({"gbt_classic": ml.candidates("smoke")["gbt_classic"]}, folded)
    left = {name for name in set(os.listdir(root)) - before if "-" in name and name.split("-")[0] in WORK_TABLES}
    assert figures.count() == 5 and not left


WORK_TABLES = {"folds", "assembled", "forest", "trees", "scored", "dictionary", "category", "scores", "score"}


def test_missing_artefacts(spark, path):
    with pytest.raises(RuntimeError, match="cannot load"):
        load_model(path("none"))
    with pytest.raises(RuntimeError, match="dictionary"):
        load_dictionary(spark, path("none"))
    assert load_dictionary(spark, path("none"), required=False) is None


def test_rule_model_equals_its_rule(spark, clean):
    dictionary = fit_dictionary(feature_projection(crop(spark, DATA), "crop"), CATEGORY_FEATURES)
    scored = score(clean, rule_model(), dictionary)
    rule = (F.coalesce("moisturePct", F.lit(0.0)) <= 25).cast("long")
    assert scored.where(F.col("needsIrrigation") != rule).count() == 0


def test_importance_sums_to_one_and_finds_moisture(forest, features):
    found = ml.variable_importance(forest[0]).collect()
    assert sorted(r.variable for r in found) == sorted(FEATURES)
    assert sum(r.importance for r in found) == pytest.approx(1.0)
    assert found[0].variable == "moi"


def test_cross_validation_and_choice(spark, features):
    folded = sampling.stratified_folds(features, k=2)
    names = ("gbt_classic", "random_forest")
    estimators = {n: ml.candidates("smoke")[n] for n in names}
    results = ml.cross_validate(estimators, folded, parallelism=2)
    assert {(r.model, r.fold) for r in results.collect()} == {(n, f) for n in names for f in (0, 1)}
    assert results.where("f1 < 0.8 OR roc_auc < 0.9 OR roc_auc > 1").count() == 0
    parts = sampling.stratified_split(features)
    train, valid = (parts.where(F.col("split") == p).drop("split") for p in ("train", "valid"))
    name, model, dictionary = ml.fit_best(estimators, results, train)
    assert name == best_model(cv_summary(results)).first()["model"]
    report = {r["class"]: r for r in ml.evaluate_holdout(model, dictionary, valid).collect()}
    majority = valid.agg(F.greatest(F.avg(LABEL), 1 - F.avg(LABEL))).first()[0]
    assert report["accuracy"]["f1"] > majority
    assert report["accuracy"]["support"] == valid.count()


def test_network(features):
    model, dictionary = ml.train_network(features, "smoke")
    scored = ml.predict(features, model, dictionary)
    assert scored.count() == features.count()
    assert scored.where(~F.col("score").between(0, 1)).count() == 0


def test_training_job(spark, path):
    write_crop_csv(crop(spark, DATA), path("csv"))
    cfg = TrainingConfig(
        csv_path=path("csv"),
        model_path=path("model"),
        dictionary_path=path("dictionary"),
        report_path=path("report"),
        profile="smoke",
        folds=2,
    )
    name = run_training(spark, cfg)
    assert name in ml.candidates("smoke")
    model = load_model(cfg.model_path)
    clean = clean_readings(sensor_envelope(read_table(spark, DATA, "events")))
    assert score(clean, model, load_dictionary(spark, cfg.dictionary_path)).count() == clean.count()

    def report(part):
        return spark.read.parquet(f"{cfg.report_path}/{part}")

    cleaned = clean_crop(crop(spark, DATA))
    assert report("label_distribution").agg(F.sum("rows")).first()[0] == cleaned.count()
    assert report("cv_summary").count() == 5 and report("fold_metrics").count() == 10
    valid_rows = report("label_share").where("split = 'valid'").agg(F.sum("rows")).first()[0]
    for prefix in ("best", "network"):
        assert report(f"{prefix}_confusion_matrix").agg(F.sum("rows")).first()[0] == valid_rows
    assert report("best_roc_auc").first()[0] > 0.9
    assert report("variable_importance").count() == 6


def test_training_refit_choice():
    with pytest.raises(ValueError, match="refit_on"):
        TrainingConfig(csv_path="x", refit_on="some")


def test_four_candidates_are_fitted_on_every_row(spark, monkeypatch):
    seen = {}
    keep = ml.train

    def watched(rows, learner, *more):
        seen[name] = learner.rows_to_fit
        return keep(rows, learner, *more)

    monkeypatch.setattr(queries, "PROFILE", "smoke")
    monkeypatch.setattr(ml, "train", watched)
    for name in ("gbt_deep", "gbt_wide", "random_forest", "gbt_classic"):
        assert "rows_to_fit" not in ORACLES[f"train_{name}"]
    for name in ("gbt_classic", "random_forest"):
        assert "rows_to_fit" not in queries.QUERIES[f"train_{name}"](spark, DATA).columns and seen[name] is None


def test_extra_trees_are_fitted_on_every_row(spark, monkeypatch):
    seen, keep = {}, ml.train

    def watched(rows, learner, *more):
        model = keep(rows, learner, *more)
        # Without draws, the root of each tree has the share of ones among all rows, weighted.
        seen.update(bound=learner.rows_to_fit, roots=[r["share"] for r in model[0].stages[-1].nodes.where("id = 0").collect()])
        return model

    monkeypatch.setattr(queries, "PROFILE", "smoke")
    monkeypatch.setattr(ml, "train", watched)
    monkeypatch.setattr(trees, "sample_rows", _unsampled(trees.sample_rows))
    assert "rows_to_fit" not in ORACLES["train_extra_trees"] and "rows_to_fit" not in queries.QUERIES["train_extra_trees"](spark, DATA).columns
    assert seen["bound"] is None and seen["roots"] == pytest.approx([0.5] * 8)


def _unsampled(keep):
    def rows(rows, most, *more):
        assert most is None, "the fit is on a sample"
        return keep(rows, most, *more)

    return rows


class _Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["cv_summary", "best_model"])
def test_candidates_are_compared_on_every_row(spark, monkeypatch, name):
    def seen(estimators, *more):
        assert set(estimators) == set(ml.ROUNDS["reference"])
        raise _Seen({e.rows_to_fit for e in estimators.values()})

    monkeypatch.setattr(ml, "cross_validate", seen)
    with pytest.raises(_Seen) as found:
        queries.QUERIES[name](spark, DATA)
    assert found.value.args == ({None},)
