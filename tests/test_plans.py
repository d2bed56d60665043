"""Plan shapes that matter at scale: pruned scans, no needless shuffles, early limits, size-based broadcasts."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from furrow.operators import metrics, profiling, quality, quantiles, sampling
from furrow.operators.encoding import fit_dictionary, label_encode
from furrow.operators.features import CategorySlots, feature_projection, feature_stages, hot_names
from furrow.operators.readings import clean_readings, log_extract
from furrow.operators.scoring import score
from furrow.plans import queries
from furrow.plans.bindings import crop, read_table, rule_model, sensor_envelope
from furrow.schemas import CATEGORY_FEATURES
from furrow.sources.tables import readings_table, write_readings
from furrow.workspace import materialize
from tests.conftest import DATA


@pytest.fixture
def plan(capsys):
    def text(df) -> str:
        capsys.readouterr()
        df.explain("simple")
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def clean(spark):
    return clean_readings(sensor_envelope(read_table(spark, DATA, "events")))


@pytest.fixture(scope="module")
def cleaned(spark):
    return materialize(quality.clean_crop(crop(spark, DATA)), "cleaned")


def test_cleaning_and_scoring_do_not_shuffle(spark, plan, clean):
    dictionary = fit_dictionary(crop(spark, DATA), CATEGORY_FEATURES)
    assert "Exchange" not in plan(clean)
    scored = plan(score(clean, rule_model(), dictionary))
    assert "Exchange hashpartitioning" not in scored and "Python" not in scored


def test_scan_reads_only_what_is_asked(spark, plan, cleaned):
    text = plan(quality.label_distribution(cleaned))
    assert "ReadSchema: struct<result:int>" in text
    assert "PushedFilters: [In(result, [0,1])]" in plan(quality.valid_labels(cleaned))


def test_labels_are_filtered_before_rows_are_compared(spark, plan):
    text = plan(quality.clean_crop(crop(spark, DATA)))
    assert text.index("Exchange hashpartitioning") < text.index("Filter")


def test_split_is_a_projection(plan, cleaned):
    for sample in (sampling.stratified_split(cleaned), sampling.stratified_folds(cleaned)):
        text = plan(sample)
        assert "Exchange" not in text and "Sort" not in text and "Join" not in text


def test_log_extract_keeps_the_top_rows_per_task(spark, plan, clean):
    text = plan(log_extract(clean.withColumn("needsIrrigation", F.lit(1))))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_top_categories_are_limited_before_the_shuffle(spark, plan):
    text = plan(profiling.top_categories(crop(spark, DATA), CATEGORY_FEATURES))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dictionary_join_follows_the_threshold(spark, plan):
    rows = quality.trim_categories(crop(spark, DATA))
    encoded = label_encode(rows, fit_dictionary(rows, CATEGORY_FEATURES), CATEGORY_FEATURES)
    text = plan(encoded)
    assert text.count("BroadcastHashJoin") == 3 and "Exchange hashpartitioning" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(encoded.select("*"))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregates_combine_before_the_shuffle(plan, cleaned):
    for df in (
        quality.dedupe_rows(cleaned),
        profiling.crosstab(cleaned, "crop_id"),
        profiling.iqr_bounds(cleaned),
        metrics.confusion_matrix(cleaned.withColumn("prediction", F.lit(1))),
    ):
        text = plan(df)
        assert "partial_" in text or text.count("HashAggregate") >= 2


def test_dates_prune_the_readings_table(spark, plan, clean, path):
    write_readings(clean, path("readings"))
    text = plan(spark.read.parquet(path("readings")).where("date = DATE'2024-01-05'"))
    assert "PartitionFilters: [isnotnull(date" in text
    assert readings_table(clean).columns[-1] == "date"


def test_quantiles_rank_no_whole_column_in_a_task(plan, cleaned):
    for df in (profiling.iqr_bounds(cleaned), profiling.boxplot_stats(cleaned)):
        windows = [line for line in plan(df).splitlines() if "windowspecdefinition(" in line]
        assert windows and all("prob" in line.split("windowspecdefinition(")[1] for line in windows)


def test_auc_ranges_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(metrics, "ROWS_PER_RANGE", 100)
    made, keep = [], metrics.materialize
    monkeypatch.setattr(metrics, "materialize", lambda df, name: made.append((name, keep(df, name))) or made[-1][1])
    rows = spark.range(3000).select((F.col("id") % 1000 / 1000).alias("score"), (F.col("id") % 7 > 3).cast("int").alias("result"))
    assert metrics.roc_auc(rows).first()[0] == pytest.approx(0.5, abs=0.05)
    assert made[-1][0] == "score-ranges" and made[-1][1].select("range").distinct().count() == 10


def test_quantiles_read_the_table_twice(spark, cleaned, monkeypatch):
    """Once for the sketch and once for the values inside its brackets; what follows reads those."""
    written, keep = [], quantiles.materialize

    def watched(df, name):
        written.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(quantiles, "materialize", watched)
    found = quantiles.exact_quantiles(cleaned, ["moi", "temp"], [0.25, 0.5])
    assert [name for name, _ in written] == ["quantile-brackets", "quantile-values"]
    reads = [sum(line.count("moi#") > 0 and "Relation" in line for line in plan.split("\n")) for _, plan in written]
    assert reads == [1, 1]
    last = found._jdf.queryExecution().optimizedPlan().toString()
    assert "moi#" not in last and "percentile(" not in last


def test_names_of_hot_slots_leave_rows_in_place(plan, cleaned):
    rows = feature_projection(cleaned, "crop").withColumn("row", F.monotonically_increasing_id())
    model = Pipeline(stages=feature_stages(slots=CategorySlots.fitted(fit_dictionary(rows, CATEGORY_FEATURES)))).fit(rows)
    named = hot_names(model.transform(rows), model, ["crop_id"], "row")
    text = plan(named)
    assert "Generate" not in text and "collect_list" not in text and "SortMergeJoin" not in text
    first = named.orderBy("row").first()
    assert first["hot"].startswith(f"crop_id_{first['crop_id']} soil_type_") and named.count() == cleaned.count()


def test_the_round_trip_cleans_its_rows_once(spark, monkeypatch):
    monkeypatch.setattr(queries, "PROFILE", "smoke")
    found = queries.QUERIES["model_roundtrip"](spark, DATA)
    assert not [file for file in found.inputFiles() if "lineitem" in file]
    assert found.count() == 1
