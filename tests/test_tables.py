"""Quality, profile, quantile, sampling, encoding and metric operators against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.operators import metrics, profiling, quality, quantiles, sampling
from furrow.operators.encoding import RARE, bucket_rare, category_frequency, fit_dictionary, label_encode
from furrow.operators.features import feature_projection, standardize
from furrow.schemas import CATEGORY_FEATURES, CROP_SCHEMA, FEATURES, require_columns
from furrow.sources.crop_table import read_crop_csv, write_crop_csv
from tests.conftest import rows

NAN = float("nan")


def crop(spark, data):
    return spark.createDataFrame(data, CROP_SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    data = [
        (" wheat ", "clay", "Seedling", 10.0, 20.0, 50.0, 1),
        ("wheat", "clay\t", "Seedling", 10.0, 20.0, 50.0, 1),
        ("wheat", "clay", "Seedling", NAN, 20.0, 50.0, 1),
        ("wheat", "clay", "Seedling", None, 20.0, 50.0, 1),
        ("maize", None, "Flowering", 40.0, 25.0, 60.0, 0),
        ("maize", "loam", "Flowering", 41.0, 25.0, 60.0, 2),
        ("rice", "loam", None, 42.0, 25.0, 60.0, None),
    ]
    return crop(spark, data)


# Quality


def test_dedupe_treats_nan_and_null_as_one(small):
    cleaned = quality.trim_categories(small)
    assert quality.dedupe_rows(cleaned).count() == 5
    assert quality.duplicate_count(cleaned).first()["duplicates"] == 2


def test_null_profile_counts_nan(small):
    found = dict(rows(quality.null_profile(small)))
    assert found == {
        "crop_id": 0, "soil_type": 1, "seedling_stage": 1, "moi": 2, "temp": 0, "humidity": 0, "result": 1,
    }


def test_label_domain(small):
    assert quality.valid_labels(small).count() == 5
    assert quality.invalid_label_count(small).first()["invalid"] == 2
    assert {r.result for r in quality.label_violations(small).collect()} == {2, None}
    with pytest.raises(ValueError, match="result"):
        quality.assert_label_domain(small)
    quality.assert_label_domain(quality.valid_labels(small))


def test_counts_on_an_empty_table(small):
    empty = small.where("moi < 0")
    assert quality.duplicate_count(empty).first()["duplicates"] == 0
    assert quality.invalid_label_count(empty).first()["invalid"] == 0
    assert [r.rows for r in metrics.confusion_matrix(empty.withColumn("prediction", F.lit(1))).collect()] == [0] * 4


def test_require_columns(small):
    with pytest.raises(ValueError, match="MOI"):
        require_columns(small, ["moi", "MOI"])


def test_cardinality_ignores_nulls(small):
    exact = dict(rows(quality.category_cardinality(quality.trim_categories(small), CATEGORY_FEATURES)))
    assert exact == {"crop_id": 3, "soil_type": 2, "seedling_stage": 2}
    assert dict(rows(quality.category_cardinality(quality.trim_categories(small), CATEGORY_FEATURES, approx=True)))


def test_crosstab_fills_zeros(small):
    found = rows(profiling.crosstab(quality.trim_categories(small), "crop_id"))
    assert found == [("maize", 1, 0), ("wheat", 0, 4)]


# CSV


def test_csv_round_trip_keeps_padding(spark, small, path):
    write_crop_csv(small, path("crop"))
    back = read_crop_csv(spark, path("crop"))
    assert sorted(map(str, rows(back, "crop_id"))) == sorted(
        map(str, rows(quality.normalize_missing(small), "crop_id"))
    )


def test_csv_columns_are_found_by_name_and_texts_are_coerced(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "result,MOI,crop ID,soil_type,Seedling Stage,temp,humidity,extra\n"
        "1,12.5, wheat,NA,Flowering,bad,60,x\n"
        "0.5,NaN,maize,clay,,21,n/a,y\n"
        "1.0,3,rice,loam,S,1,2,z\n"
    )
    got = [tuple(r) for r in read_crop_csv(spark, f"file://{tmp_path}/c.csv").collect()]
    assert got == [
        (" wheat", None, "Flowering", 12.5, None, 60.0, 1),
        ("maize", "clay", None, None, 21.0, None, None),
        ("rice", "loam", "S", 3.0, 1.0, 2.0, 1),
    ]


def test_csv_without_a_column_names_it(spark, tmp_path):
    (tmp_path / "c.csv").write_text("result,MOI\n1,2\n")
    with pytest.raises(ValueError, match="crop ID"):
        read_crop_csv(spark, f"file://{tmp_path}/c.csv")


# Quantiles and outliers


def spread(kind: str, n: int) -> list[float]:
    rng = random.Random(7)
    return {
        "even": [rng.random() for _ in range(n)],
        "one value": [3.0] * n,
        "a third equal": [5.0 if i % 3 == 0 else rng.gauss(5, 2) for i in range(n)],
        "far outlier": [rng.random() for _ in range(n - 1)] + [1e300],
        "two heaps": [float(i % 2) for i in range(n)],
        "powers": [math.exp(rng.uniform(-300, 300)) for _ in range(n)],
    }[kind]


@pytest.mark.parametrize("kind", ["even", "one value", "a third equal", "far outlier", "two heaps", "powers"])
@pytest.mark.parametrize("n", [1, 2, 5, 2000, 2001, 30011])
def test_exact_quantiles(spark, kind, n):
    data = spread(kind, n)
    df = spark.createDataFrame([(v,) for v in [*data, None, NAN]], "v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = quantiles.exact_quantiles(df, ["v"], probs)
    got = [r["quantile"] for r in found.orderBy("prob").collect()]
    assert got == pytest.approx(list(np.quantile(data, probs)), rel=1e-12)


def test_quantiles_per_group_of_very_different_size(spark):
    rng = random.Random(3)
    data = [(0, rng.random()) for _ in range(20000)] + [(1, rng.random() * 9) for _ in range(7)] + [(2, 1.0)]
    df = spark.createDataFrame(data, "g int, v double")
    found = rows(quantiles.exact_quantiles(df, ["v"], [0.25], "g", [0, 1]).select("g", "quantile"))
    assert [g for g, _ in found] == [0, 1]
    for g, q in found:
        assert q == pytest.approx(np.quantile([v for k, v in data if k == g], 0.25), rel=1e-12)


def test_approx_bounds_are_near(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10001)], "moi double")
    exact = profiling.iqr_bounds(df, ["moi"]).first()
    approx = profiling.iqr_bounds(df, ["moi"], approx=True).first()
    assert exact["lo"] == -5000.0 and exact["hi"] == 15000.0
    assert approx["lo"] == pytest.approx(exact["lo"], abs=10)


def test_outliers_include_missing_values(spark):
    df = crop(spark, [("a", "b", "c", v, 1.0, 1.0, 0) for v in [1.0, 2.0, 3.0, 2.0, 99.0, None, NAN]])
    flags = profiling.outlier_flags(df, profiling.iqr_bounds(df))
    assert dict(rows(profiling.outlier_counts(flags))) == {"moi": 3, "temp": 0, "humidity": 0}
    assert profiling.outlier_union(flags).count() == 3


def test_outliers_of_an_all_missing_column(spark):
    df = crop(spark, [("a", "b", "c", None, 1.0, 1.0, 0)] * 3)
    flags = profiling.outlier_flags(df, profiling.iqr_bounds(df))
    assert dict(rows(profiling.outlier_counts(flags)))["moi"] == 3


def test_boxplot_whiskers(spark):
    values = {0: [1.0, 2.0, 3.0, 4.0, 100.0, -80.0], 1: [5.0] * 4 + [9.0]}
    df = crop(spark, [("a", "b", "c", v, 1.0, 1.0, k) for k, vs in values.items() for v in vs])
    found = {r["result"]: r for r in profiling.boxplot_stats(df, ["moi"]).collect()}
    for k, vs in values.items():
        q1, med, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
        reach = 1.5 * (q3 - q1)
        inside = [v for v in vs if q1 - reach <= v <= q3 + reach]
        assert (found[k]["q1"], found[k]["med"], found[k]["q3"]) == pytest.approx((q1, med, q3))
        assert found[k]["whisker_lo"] == min(min(inside), q1)
        assert found[k]["whisker_hi"] == max(max(inside), q3)
        assert found[k]["fliers"] == len(vs) - len(inside)


# Samples


def expected_parts(data, columns, label, cut_ranks, spark):
    """Parts by sorting everything."""
    hashed = spark.createDataFrame(data, columns)
    hashed = hashed.withColumn("h", sampling.row_hash(hashed, 42))
    found = Counter()
    for v in (0, 1):
        mine = sorted((r for r in hashed.collect() if r[label] == v), key=lambda r: r.h)
        cuts = cut_ranks(len(mine))
        for rank, r in enumerate(mine, 1):
            found[(*tuple(r)[:-1], sum(c < rank for c in cuts))] += 1
    return found


def sample_rows(kind: str):
    rng = random.Random(11)
    data = {
        "distinct": [(i, i % 3 == 0) for i in range(503)],
        "third copies": [(0 if i % 3 == 0 else i, i % 2) for i in range(600)],
        "all copies": [(5, i % 2) for i in range(101)],
        "few": [(1, 0), (2, 1), (3, 1)],
        "one class": [(i, 1) for i in range(20)],
        "other labels": [(rng.randrange(40), rng.randrange(4)) for _ in range(300)],
    }[kind]
    return [(a, int(b)) for a, b in data]


KINDS = ["distinct", "third copies", "all copies", "few", "one class", "other labels"]


@pytest.mark.parametrize("kind", KINDS)
def test_split_is_exact(spark, kind):
    data = sample_rows(kind)
    df = spark.createDataFrame(data, "x int, result int").repartition(5)
    got = Counter(
        (r.x, r.result, 0 if r.split == "valid" else 1) for r in sampling.stratified_split(df).collect()
    )
    assert got == expected_parts(data, "x int, result int", "result", lambda n: [math.ceil(0.2 * n)], spark)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_folds_are_exact(spark, kind, chunk, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_CHUNK", chunk)
    data = sample_rows(kind)
    df = spark.createDataFrame(data, "x int, result int").repartition(5)
    got = Counter(tuple(r) for r in sampling.stratified_folds(df).collect())
    cuts = lambda n: [-(-n * i // 5) for i in range(1, 5)]
    assert got == expected_parts(data, "x int, result int", "result", cuts, spark)
    for v in (0, 1):
        sizes = [sum(n for (x, label, fold), n in got.items() if label == v and fold == f) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_only_equal_rows_share_a_hash(spark):
    texts = [None, "", "a", "|", "a|", "|a", "\\", "\\N", "\\|", "N"]
    df = spark.createDataFrame([(p, q, 0) for p in texts for q in texts], "p string, q string, result int")
    assert df.select(sampling.row_hash(df, 42)).distinct().count() == len(texts) ** 2


def test_split_refuses_a_senseless_fraction(spark):
    with pytest.raises(ValueError, match="fraction"):
        sampling.stratified_split(spark.range(2).selectExpr("id", "1 result"), fraction=0.0)


def test_another_seed_gives_another_split(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 2 as int) result")
    first = sampling.stratified_split(df, seed=1).where("split = 'valid'")
    second = sampling.stratified_split(df, seed=2).where("split = 'valid'")
    assert first.count() == second.count() == 200
    assert first.exceptAll(second).count() > 0


# Dictionaries


def categories(spark):
    data = [("b", "x"), ("a", "x"), ("b ", None), ("é", "x"), ("Z", "y")] + [("c", "x")] * 6
    return spark.createDataFrame(data, "p string, q string")


def test_dictionary_is_in_text_order(spark):
    found = rows(fit_dictionary(categories(spark), ["p", "q"]).select("column", "idx", "category", "rows"))
    assert found == [
        ("p", 0, "Z", 1), ("p", 1, "a", 1), ("p", 2, "b", 2), ("p", 3, "c", 6), ("p", 4, "é", 1),
        ("q", 0, "x", 9), ("q", 1, "y", 1),
    ]


def test_dictionary_of_many_categories(spark):
    df = spark.range(20000).select(F.concat(F.lit("c"), "id").alias("p"), (F.col("id") % 3).cast("string").alias("q"))
    found = fit_dictionary(df.repartition(16), ["p", "q"]).where("column = 'p'").orderBy("category").collect()
    assert [r.idx for r in found] == list(range(20000))
    assert [r.category for r in found] == sorted(f"c{i}" for i in range(20000))


def test_label_encode_by_broadcast_and_by_shuffle(spark):
    dictionary = fit_dictionary(categories(spark), ["p", "q"])
    data = [("a", "y"), ("new", "x"), (None, None)] + [("b", "x")] * 50
    df = spark.createDataFrame(data, "p string, q string")
    want = sorted([(1, 1), (-1, 0), (-1, -1)] + [(2, 0)] * 50)
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            assert rows(label_encode(df, dictionary, ["p", "q"])) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rare_categories_share_a_bucket(spark):
    df = quality.trim_categories(categories(spark), ["p", "q"])
    dictionary = fit_dictionary(df, ["p", "q"])
    scored = spark.createDataFrame([("c", "x"), ("a", "y"), ("unseen", None)], "p string, q string")
    found = {tuple(r) for r in bucket_rare(scored, dictionary, ["p", "q"]).collect()}
    assert found == {("c", "x"), (RARE, RARE), (None, None)}
    frequency = {(r.column, r.category): r.rare for r in category_frequency(df, ["p", "q"]).collect()}
    assert frequency[("p", "c")] is False and frequency[("p", "b")] is True


def test_top_categories_break_ties_by_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "p string")
    assert rows(profiling.top_categories(df, ["p"], 2).select("rank", "category", "rows")) == [
        (1, "c", 2), (2, "a", 1),
    ]


# Features


def test_features_are_the_same_for_readings_and_crops(spark, small):
    assert feature_projection(small, "crop").columns == [*FEATURES, "result"]
    flags = [r.seedling_stage for r in feature_projection(small, "crop").collect()]
    assert flags == ["Yes"] * 4 + ["No"] * 3
    kept = [r.seedling_stage for r in feature_projection(small, "crop", stage_as="text").collect()]
    assert kept[4] == "Flowering" and kept[6] is None


def test_standardize_fits_on_the_training_part(spark):
    df = spark.createDataFrame([(1.0, "t"), (3.0, "t"), (9.0, "v")], "moi double, part string")
    got = [r.moi for r in standardize(df, df.where("part = 't'"), ["moi"]).collect()]
    assert got == [-1.0, 1.0, 7.0]
    constant = df.withColumn("moi", F.lit(4.0))
    assert [r.moi for r in standardize(constant, constant, ["moi"]).collect()] == [0.0] * 3


# Metrics


def scored(spark, n=4000, levels=None, seed=5):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        label = int(rng.random() < 0.4)
        score = min(max(rng.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0)
        data.append((label, round(score * levels) / levels if levels else score))
    return data, spark.createDataFrame(data, "result int, score double").withColumn(
        "prediction", metrics.threshold_class(F.col("score"))
    )


@pytest.mark.parametrize("levels", [None, 3, 1])
def test_roc_auc(spark, levels):
    data, df = scored(spark, 1200, levels)
    pos = [s for label, s in data if label == 1]
    neg = [s for label, s in data if label == 0]
    pairs = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(pairs / len(pos) / len(neg), rel=1e-12)


def test_roc_auc_with_scores_in_a_narrow_heap(spark):
    data = [(i % 2, 0.5 + (i * 7919 % 5000) * 1e-12) for i in range(5000)] + [(1, 1e9), (0, -1e9)]
    df = spark.createDataFrame(data, "result int, score double")
    order = sorted(data, key=lambda r: r[1])
    neg = pairs = 0
    for label, _ in order:
        pairs += neg if label else 0
        neg += 1 - label
    assert metrics.roc_auc(df).first()[0] == pytest.approx(pairs / neg / (len(data) - neg), rel=1e-12)


def test_roc_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "result int, score double")
    assert metrics.roc_auc(df).first()[0] is None


def test_report_agrees_with_counts(spark):
    data, df = scored(spark)
    cells = {(a, p): n for a, p, n in rows(metrics.confusion_matrix(df))}
    assert sum(cells.values()) == len(data)
    one = metrics.binary_metrics(df).first()
    precision = cells[1, 1] / (cells[1, 1] + cells[0, 1])
    recall = cells[1, 1] / (cells[1, 1] + cells[1, 0])
    assert one["precision"] == pytest.approx(precision) and one["recall"] == pytest.approx(recall)
    assert one["f1"] == pytest.approx(2 * precision * recall / (precision + recall))
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["recall"] == pytest.approx(recall, abs=1e-4)
    assert report["accuracy"]["f1"] == pytest.approx((cells[0, 0] + cells[1, 1]) / len(data), abs=1e-4)
    assert report["weighted avg"]["support"] == len(data)


def test_metrics_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "result int, prediction int")
    assert tuple(metrics.binary_metrics(df).first()) == (0.0, 0.0, 0.0)


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "result int")
    assert dict(rows(metrics.with_class_weight(df).distinct())) == {0: 8 / 12, 1: 2.0}


def test_cv_summary_and_choice(spark):
    data = [("a", 0, 0.5, 1.0, 0.5, 0.7), ("a", 1, 0.7, 1.0, 0.5, 0.9), ("b", 0, 0.6, 1.0, 0.5, 0.9), ("b", 1, 0.6, 1.0, 0.5, 0.7)]
    folds = spark.createDataFrame(
        data, "model string, fold int, f1 double, precision double, recall double, roc_auc double"
    )
    summary = metrics.cv_summary(folds)
    assert {r.model: round(r.f1, 9) for r in summary.collect()} == {"a": 0.6, "b": 0.6}
    assert metrics.best_model(summary, "precision").first()["model"] == "a"


def test_csv_files_of_one_header_and_quotes(spark, tmp_path, path):
    header, folder = "crop ID,soil_type,Seedling Stage,MOI,temp,humidity,result", tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(f'{header}\n"a ""q"" b",s,Yes,1,2,3,1\n')
    read = read_crop_csv(spark, path("csv"))
    assert read.first()["crop_id"] == 'a "q" b'
    write_crop_csv(read, path("again"))
    assert read_crop_csv(spark, path("again")).collect() == read.collect()
    (folder / "b.csv").write_text(header.replace("MOI,temp", "temp,MOI") + "\nx,s,Yes,5,99,3,1\n")
    with pytest.raises(Exception, match="header"):
        read_crop_csv(spark, path("csv")).collect()


def test_exact_quantiles_of_few_rows_and_hot_values(spark):
    for n in (1, 2, 3, 5, 6, 7, 40, 3000):
        values = [float((i * 7919) % 97) for i in range(n)] + [50.0] * (n // 2)
        df = spark.createDataFrame([(v,) for v in values], "x double")
        probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
        got = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, ["x"], probs).collect()}
        for p in probs:
            ordered, at = sorted(values), p * (len(values) - 1)
            low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
            assert got[p] == pytest.approx(low + (high - low) * (at - math.floor(at)))
