"""One callable per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.config import JobConfig, SourceConfig
from furrow.functions.text import fill_missing, seedling_flag, strip
from furrow.operators import metrics, profiling, quality, readings, sampling
from furrow.operators import training as ml
from furrow.operators.encoding import bucket_rare, category_frequency, fit_dictionary, label_encode
from furrow.operators.features import (
    CategorySlots,
    feature_projection,
    feature_stages,
    hot_names,
    standardize,
)
from furrow.operators.scoring import ENCODED, RAW, score, score_mode
from furrow.plans.bindings import (
    CROP_KEYS,
    crop,
    props_envelope,
    read_table,
    rule_model,
    rule_scored,
    sensor_envelope,
    stream_events,
    text_numbers,
)
from furrow.schemas import CATEGORY_FEATURES, CONSOLE_COLUMNS, LABEL, NUMERIC_FEATURES, project
from furrow.sources.artefacts import load_dictionary, load_model, save_dictionary, save_model
from furrow.sources.crop_table import read_crop_csv, write_crop_csv
from furrow.sources.envelope import encode_envelope, raw_tap, read_envelope
from furrow.sources.tables import compact_dates, live_rows, read_predictions, read_readings, with_date
from furrow.streaming import jobs
from furrow.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PROFILE = "reference"  # the stated sizes
AUC_FLOOR = 0.95


def _comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, dates and bytes as text: the types other engines show alike."""
    shown = {"timestamp": "timestamp_ntz", "date": "string", "binary": "string"}
    return df.select(*[F.col(c).cast(shown[t]).alias(c) if t in shown else F.col(c) for c, t in df.dtypes])


def query(name: str) -> Callable[[Query], Query]:
    """Register a query by name."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _comparable(fn(spark, sf_dir))

        QUERIES[name] = run
        return run

    return register


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def _envelope(spark, sf_dir):
    return sensor_envelope(_events(spark, sf_dir))


def _clean(spark, sf_dir):
    return readings.clean_readings(_envelope(spark, sf_dir))


def _clean_stream(spark, sf_dir):
    return readings.clean_readings(sensor_envelope(stream_events(spark, sf_dir)))


def _job(spark, name) -> JobConfig:
    root = new_path(spark, name)
    return JobConfig(
        readings_path=f"{root}/readings",
        predictions_path=f"{root}/predictions",
        checkpoint_root=f"{root}/checkpoints",
        model_path=f"{root}/model",
        dictionary_path=f"{root}/dictionary",
        query_prefix=root.rsplit("/", 1)[-1],
    )


def _finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()


def _crop_dictionary(spark, sf_dir):
    features = feature_projection(crop(spark, sf_dir), "crop")
    return fit_dictionary(features, CATEGORY_FEATURES)


def _clean_crop(spark, sf_dir):
    return quality.clean_crop(crop(spark, sf_dir))


def _stored_crop(spark, sf_dir, variant="plain"):
    """The cleaned table written once, for operators that read it several times."""
    return materialize(quality.clean_crop(crop(spark, sf_dir, variant)), "cleaned")


# Sources and sinks


@query("stream_envelope_scan")
def q_stream_envelope_scan(spark, sf_dir):
    source = SourceConfig(format="parquet", path=new_path(spark, "topic"))
    _envelope(spark, sf_dir).select("key", "value").write.parquet(source.path)
    cfg = _job(spark, "scan")
    stream = read_envelope(spark, source)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", cfg.checkpoint_path("scan"))
    _finish(writer.option("path", cfg.readings_path).trigger(availableNow=True).start())
    landed = spark.read.parquet(cfg.readings_path)
    return landed.agg(F.count(F.lit(1)).alias("records"), F.count("value").alias("with_value"))


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    path = new_path(spark, "crop-csv")
    write_crop_csv(crop(spark, sf_dir, "nulls"), path)
    return read_crop_csv(spark, path)


@query("sink_sensors")
def q_sink_sensors(spark, sf_dir):
    cfg = _job(spark, "sink-sensors")
    _finish(jobs.start_readings(_clean_stream(spark, sf_dir), cfg, available_now=True))
    return spark.read.parquet(cfg.readings_path)


@query("sink_predictions")
def q_sink_predictions(spark, sf_dir):
    cfg = _job(spark, "sink-predictions")
    dictionary = _crop_dictionary(spark, sf_dir)
    _finish(
        jobs.start_predictions(_clean_stream(spark, sf_dir), rule_model(), cfg, dictionary, available_now=True)
    )
    return spark.read.parquet(cfg.predictions_path)


@query("console_tap")
def q_console_tap(spark, sf_dir):
    cfg = _job(spark, "console")

    def land(batch, batch_id, rows):
        batch.write.mode("overwrite").parquet(f"{cfg.readings_path}/batch={batch_id}")

    _finish(jobs.start_console(_clean_stream(spark, sf_dir), cfg, available_now=True, show=land))
    return project(spark.read.parquet(cfg.readings_path), CONSOLE_COLUMNS)


@query("foreach_batch_fanout")
def q_foreach_batch_fanout(spark, sf_dir):
    cfg = _job(spark, "fanout")
    clean = _clean_stream(spark, sf_dir)
    dictionary = _crop_dictionary(spark, sf_dir)
    _finish(
        jobs.start_console(clean, cfg, available_now=True, show=lambda batch, batch_id, rows: batch.take(rows)),
        jobs.start_fanout(clean, rule_model(), cfg, dictionary, available_now=True, show=None),
    )
    readings_rows = read_readings(spark, cfg.readings_path).select(F.lit("readings").alias("table"), "*")
    predicted = read_predictions(spark, cfg.predictions_path).select(F.lit("predictions").alias("table"), "*")
    return readings_rows.unionByName(predicted, allowMissingColumns=True)


@query("compact_dates")
def q_compact_dates(spark, sf_dir):
    """Rows of both tables after four batches, a compaction of all dates but the last, and a replay of two batches.

    ``parts`` is the number of partitions in which the rows of a date stand.
    """
    cfg = _job(spark, "compaction")
    events = _events(spark, sf_dir).withColumn("batch", F.col("event_id") % 4)
    dictionary = _crop_dictionary(spark, sf_dir)

    def deliver(batch):
        clean = readings.clean_readings(sensor_envelope(events.where(F.col("batch") == batch).drop("batch")))
        jobs.fanout_batch(clean, batch, rule_model(), cfg, dictionary, show=None)

    for batch in range(4):
        deliver(batch)
    last = read_readings(spark, cfg.readings_path).agg(F.max("date").cast("string")).first()[0]
    for path in (cfg.readings_path, cfg.predictions_path):
        compact_dates(spark, path, last)
    for batch in (1, 3):
        deliver(batch)
    found = []
    for name, path, read in (
        ("readings", cfg.readings_path, read_readings),
        ("predictions", cfg.predictions_path, read_predictions),
    ):
        parts = live_rows(spark, path).groupBy(F.col("date").alias("_date")).agg(F.countDistinct("run_id", "batch_id").alias("parts"))
        rows = read(spark, path).join(parts, F.col("date").eqNullSafe(F.col("_date"))).drop("_date")
        found.append(rows.select(F.lit(name).alias("table"), "*"))
    return found[0].unionByName(found[1], allowMissingColumns=True)


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """A saved model without its dictionary sees each crop row, rare soil types among them, as the fitted one does."""
    cfg = _job(spark, "roundtrip")
    # Written once, for training and both models read it.
    cleaned = feature_projection(quality.clean_crop(crop(spark, sf_dir, "rare")), "crop")
    features = materialize(cleaned, "roundtrip-rows")
    model, dictionary = ml.train(features, ml.candidates(PROFILE)["gbt_classic"])
    save_model(model, cfg.model_path)
    save_dictionary(dictionary, cfg.dictionary_path)
    seen = F.to_json(vector_to_array("features"))
    before, after = (
        m.transform(features).select(*features.columns, seen.alias("seen"), "prediction", F.lit(side).alias("side"))
        for m, side in ((model, 1), (load_model(cfg.model_path), -1))
    )
    # Rows that only one side has, as many times as it has them more often: those of exceptAll both ways, in one pass.
    both = before.unionAll(after).groupBy(*[c for c in before.columns if c != "side"])
    counted = both.agg(F.sum("side").alias("more"), F.count_if(F.col("side") == 1).alias("copies"))
    rare = F.when(F.col("soil_type").startswith("rare"), F.col("copies")).otherwise(0)
    sums = {"rows": F.col("copies"), "rare_rows": rare, "differing": F.abs("more")}
    return counted.agg(*[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in sums.items()])


@query("category_dictionary")
def q_category_dictionary(spark, sf_dir):
    path = new_path(spark, "dictionary")
    save_dictionary(fit_dictionary(crop(spark, sf_dir, "rare"), CATEGORY_FEATURES), path)
    return load_dictionary(spark, path)


@query("envelope_encode")
def q_envelope_encode(spark, sf_dir):
    fields = readings.decode_envelope(_envelope(spark, sf_dir)).withColumnRenamed("ts_raw", "ts")
    text = F.col("value").cast("string")
    return encode_envelope(fields).select(
        "key",
        F.get_json_object(text, "$.deviceId").alias("device"),
        F.get_json_object(text, "$.cropId").alias("crop"),
        F.get_json_object(text, "$.moistureIdx").cast("double").alias("moisture"),
        F.size(F.json_object_keys(text)).alias("fields"),
    )


@query("raw_tap")
def q_raw_tap(spark, sf_dir):
    return raw_tap(props_envelope(_events(spark, sf_dir)))


# Projections and filters


@query("decode_envelope")
def q_decode_envelope(spark, sf_dir):
    decoded = readings.decode_envelope(_envelope(spark, sf_dir), with_status=True)
    return decoded.select("event_id", "deviceId", "ts_raw", "cropId", "tempC", "decode_status")


@query("flatten_readings")
def q_flatten_readings(spark, sf_dir):
    return readings.decode_envelope(_envelope(spark, sf_dir)).drop("ts_raw")


@query("device_key_fallback")
def q_device_key_fallback(spark, sf_dir):
    return readings.decode_envelope(_envelope(spark, sf_dir)).select("event_id", "deviceId")


@query("harmonize_moisture")
def q_harmonize_moisture(spark, sf_dir):
    fields = readings.decode_envelope(_envelope(spark, sf_dir))
    return readings.harmonize_moisture(fields).select(
        "event_id", "soilMoisture", "moistureIdx", "moisture01", "moisturePct"
    )


@query("event_time")
def q_event_time(spark, sf_dir):
    fields = readings.decode_envelope(_envelope(spark, sf_dir))
    return readings.with_event_time(fields).select("event_id", "ts", "event_time")


@query("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    return readings.coerce_numeric(text_numbers(_events(spark, sf_dir)), ["tempC", "humidity"])


@query("clean_readings")
def q_clean_readings(spark, sf_dir):
    return _clean(spark, sf_dir)


@query("feature_projection")
def q_feature_projection(spark, sf_dir):
    return feature_projection(_clean(spark, sf_dir), "reading", keep=["event_id"])


@query("seedling_flag")
def q_seedling_flag(spark, sf_dir):
    return _clean(spark, sf_dir).select("event_id", seedling_flag("stage").alias("seedling"))


@query("valid_labels")
def q_valid_labels(spark, sf_dir):
    return quality.valid_labels(crop(spark, sf_dir, keys=True)).select(*CROP_KEYS, LABEL)


@query("label_domain_violations")
def q_label_domain_violations(spark, sf_dir):
    return quality.label_violations(crop(spark, sf_dir))


@query("date_partition")
def q_date_partition(spark, sf_dir):
    return with_date(_clean(spark, sf_dir)).select("event_id", "date")


@query("trim_categories")
def q_trim_categories(spark, sf_dir):
    return quality.trim_categories(crop(spark, sf_dir, keys=True)).select(*CROP_KEYS, *CATEGORY_FEATURES)


@query("fill_missing_category")
def q_fill_missing_category(spark, sf_dir):
    return _clean(spark, sf_dir).select("event_id", fill_missing(strip("cropId")).alias("cropId"))


@query("threshold_class")
def q_threshold_class(spark, sf_dir):
    scored = rule_scored(crop(spark, sf_dir, keys=True))
    return scored.select(*CROP_KEYS, "moi", metrics.threshold_class(F.col("score")).alias("class"))


# Dictionary joins


@query("label_encode")
def q_label_encode(spark, sf_dir):
    dictionary = fit_dictionary(crop(spark, sf_dir), CATEGORY_FEATURES)
    rows = quality.trim_categories(crop(spark, sf_dir, "rare", keys=True))
    return label_encode(rows, dictionary, CATEGORY_FEATURES).select(*CROP_KEYS, *CATEGORY_FEATURES)


@query("rare_category_bucket")
def q_rare_category_bucket(spark, sf_dir):
    rows = quality.trim_categories(crop(spark, sf_dir, "rare", keys=True))
    dictionary = fit_dictionary(rows, CATEGORY_FEATURES)
    return bucket_rare(rows, dictionary, CATEGORY_FEATURES).select(*CROP_KEYS, *CATEGORY_FEATURES)


# Profiles and aggregates


@query("table_profile")
def q_table_profile(spark, sf_dir):
    return quality.table_profile(crop(spark, sf_dir))


@query("category_cardinality")
def q_category_cardinality(spark, sf_dir):
    return quality.category_cardinality(crop(spark, sf_dir, "rare"), CATEGORY_FEATURES)


@query("top_categories")
def q_top_categories(spark, sf_dir):
    return profiling.top_categories(crop(spark, sf_dir, "rare"), CATEGORY_FEATURES)


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return quality.label_distribution(crop(spark, sf_dir))


@query("label_share")
def q_label_share(spark, sf_dir):
    return quality.label_share(sampling.stratified_split(_stored_crop(spark, sf_dir)), by="split")


@query("null_profile")
def q_null_profile(spark, sf_dir):
    return quality.null_profile(crop(spark, sf_dir, "nulls"))


@query("duplicate_count")
def q_duplicate_count(spark, sf_dir):
    return quality.duplicate_count(quality.trim_categories(crop(spark, sf_dir, "nulls")))


@query("dedupe_rows")
def q_dedupe_rows(spark, sf_dir):
    return quality.dedupe_rows(quality.trim_categories(crop(spark, sf_dir, "nulls")))


@query("distinct_labels")
def q_distinct_labels(spark, sf_dir):
    return quality.distinct_labels(crop(spark, sf_dir))


@query("crosstab_crop")
def q_crosstab_crop(spark, sf_dir):
    return profiling.crosstab(_clean_crop(spark, sf_dir), "crop_id")


@query("crosstab_soil")
def q_crosstab_soil(spark, sf_dir):
    return profiling.crosstab(_clean_crop(spark, sf_dir), "soil_type")


@query("crosstab_stage")
def q_crosstab_stage(spark, sf_dir):
    return profiling.crosstab(_clean_crop(spark, sf_dir), "seedling_stage")


@query("iqr_bounds")
def q_iqr_bounds(spark, sf_dir):
    bounds = profiling.iqr_bounds(_stored_crop(spark, sf_dir, "nulls"))
    return bounds.select("column", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query("boxplot_stats")
def q_boxplot_stats(spark, sf_dir):
    stats = profiling.boxplot_stats(_stored_crop(spark, sf_dir, "nulls"))
    rounded = [F.round(c, 6).alias(c) for c in ("q1", "med", "q3", "whisker_lo", "whisker_hi")]
    return stats.select(LABEL, "column", *rounded, "fliers")


def _flags(spark, sf_dir):
    """Outlier flags with a narrow reach, so that every column has some."""
    rows = quality.valid_labels(crop(spark, sf_dir, "nulls", keys=True))
    return profiling.outlier_flags(rows, profiling.iqr_bounds(rows, k=0.4))


@query("outlier_flags")
def q_outlier_flags(spark, sf_dir):
    return _flags(spark, sf_dir).select(*CROP_KEYS, "moi_outlier", "temp_outlier", "humidity_outlier")


@query("outlier_counts")
def q_outlier_counts(spark, sf_dir):
    return profiling.outlier_counts(_flags(spark, sf_dir))


@query("outlier_union")
def q_outlier_union(spark, sf_dir):
    return profiling.outlier_union(_flags(spark, sf_dir))


@query("invalid_label_count")
def q_invalid_label_count(spark, sf_dir):
    return quality.invalid_label_count(crop(spark, sf_dir))


@query("empty_batch_skip")
def q_empty_batch_skip(spark, sf_dir):
    cfg = _job(spark, "empty-batch")
    clean = _clean(spark, sf_dir)
    dictionary = _crop_dictionary(spark, sf_dir)
    batches = [clean.where(F.col("moisture01") < 0), clean]
    for batch_id, batch in enumerate(batches):
        jobs.fanout_batch(batch, batch_id, rule_model(), cfg, dictionary, show=None)
    return spark.read.parquet(cfg.predictions_path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(rule_scored(_clean_crop(spark, sf_dir)))


@query("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    found = metrics.binary_metrics(rule_scored(_clean_crop(spark, sf_dir)))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query("classification_report")
def q_classification_report(spark, sf_dir):
    return metrics.classification_report(rule_scored(_clean_crop(spark, sf_dir)))


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    found = metrics.roc_auc(rule_scored(_stored_crop(spark, sf_dir)))
    return found.select(F.round("roc_auc", 9).alias("roc_auc"))


@query("category_frequency")
def q_category_frequency(spark, sf_dir):
    return category_frequency(quality.trim_categories(crop(spark, sf_dir, "rare")), CATEGORY_FEATURES)


@query("class_weights")
def q_class_weights(spark, sf_dir):
    weighted = metrics.with_class_weight(_clean_crop(spark, sf_dir))
    return weighted.groupBy(LABEL, F.round("weight", 9).alias("weight")).agg(F.count(F.lit(1)).alias("rows"))


# Ordered extracts


@query("log_extract")
def q_log_extract(spark, sf_dir):
    return readings.log_extract(score(_clean(spark, sf_dir), rule_model(), _crop_dictionary(spark, sf_dir)))


@query("head_rows")
def q_head_rows(spark, sf_dir):
    rows = crop(spark, sf_dir, keys=True)
    return readings.head_rows(rows, [*CROP_KEYS, "moi", "temp", "humidity"])


# Streams


@query("stream_clean")
def q_stream_clean(spark, sf_dir):
    cfg = _job(spark, "stream-clean")
    writer = _clean_stream(spark, sf_dir).writeStream.format("parquet")
    writer = writer.option("checkpointLocation", cfg.checkpoint_path("clean")).option("path", cfg.readings_path)
    _finish(writer.trigger(availableNow=True).start())
    return spark.read.parquet(cfg.readings_path)


@query("stream_resume")
def q_stream_resume(spark, sf_dir):
    cfg = _job(spark, "resume")
    counts = []
    for run in (1, 2):
        _finish(jobs.start_readings(_clean_stream(spark, sf_dir), cfg, available_now=True))
        counts.append((run, spark.read.parquet(cfg.readings_path).count()))
    return spark.createDataFrame(counts, "run int, rows long")


def _trained(spark, sf_dir, name="gbt_classic", mode=RAW):
    """A candidate fitted on the training part; each query fits its own."""
    return ml.train(_parts(spark, sf_dir)[0], ml.candidates(PROFILE)[name], mode)


@query("stream_score")
def q_stream_score(spark, sf_dir):
    cfg = _job(spark, "stream-score")
    model, dictionary = _trained(spark, sf_dir)
    _finish(jobs.start_predictions(_clean_stream(spark, sf_dir), model, cfg, dictionary, available_now=True))
    return _score_check(spark.read.parquet(cfg.predictions_path))


def _score_check(scored):
    valid = F.coalesce(F.col("needsIrrigation").isin(0, 1), F.lit(False))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~valid).alias("unscored"))


# Samples and features


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return sampling.stratified_split(_stored_crop(spark, sf_dir))


@query("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(_stored_crop(spark, sf_dir))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    rows = crop(spark, sf_dir, "rare", keys=True)
    features = feature_projection(rows, "crop", stage_as="text", keep=CROP_KEYS)
    features = materialize(features.withColumn("row", F.monotonically_increasing_id()), "one-hot-rows")
    stage = CategorySlots.fitted(fit_dictionary(features, CATEGORY_FEATURES))
    model = Pipeline(stages=feature_stages(slots=stage)).fit(features)
    numbers = [f"{c}_filled" for c in NUMERIC_FEATURES]
    found = hot_names(model.transform(features), model, [*CROP_KEYS, *numbers], "row")
    return found.select(*CROP_KEYS, "hot", *[F.col(n).alias(n.removesuffix("_filled")) for n in numbers])


@query("standardize")
def q_standardize(spark, sf_dir):
    parts = sampling.stratified_split(_stored_crop(spark, sf_dir))
    scaled = standardize(parts, parts.where(F.col("split") == "train"))
    numbers = [F.round(F.col(c) + 0.0, 6).alias(c) for c in ("moi", "temp", "humidity")]
    return scaled.select(*CATEGORY_FEATURES, LABEL, "split", *numbers)


# Models


def _parts(spark, sf_dir):
    """Training and validation features from an exact split, written once."""
    rows = sampling.stratified_split(_stored_crop(spark, sf_dir))
    split = materialize(feature_projection(rows, "crop", keep=["split"]), "split")
    return [split.where(F.col("split") == part).drop("split") for part in ("train", "valid")]


def _holdout_check(model, dictionary, valid):
    """Hold-out size, and whether the model beats the larger class and orders the rows well."""
    scored = materialize(ml.predict(valid, model, dictionary), "scored")
    right = F.count_if(F.col("prediction") == F.col(LABEL))
    ones = F.count_if(F.col(LABEL) == 1)
    total = F.count(F.lit(1))
    checked = scored.agg(
        total.alias("valid_rows"),
        ones.alias("valid_ones"),
        F.count_if(~F.col("score").between(0, 1)).alias("bad_scores"),
        (right > F.greatest(ones, total - ones)).alias("beats_majority"),
    )
    auc = metrics.roc_auc(scored).select((F.col("roc_auc") > AUC_FLOOR).alias("good_auc"))
    return checked.crossJoin(auc)


def _train_query(name):
    @query(f"train_{name}")
    def run(spark, sf_dir):
        train, valid = _parts(spark, sf_dir)
        learner = ml.candidates(PROFILE, None)[name]  # fitted on every training row
        model, dictionary = ml.train(train, learner)
        # An unbounded depth is null.
        sizes = [
            F.lit(name).alias("model"),
            F.lit(model.stages[-1].getNumTrees).alias("size"),
            F.lit(learner.depth).cast("int").alias("depth"),
        ]
        return _holdout_check(model, dictionary, valid).select(*sizes, "*")

    return run


for _name in ml.ROUNDS["reference"]:
    _train_query(_name)


@query("train_mlp")
def q_train_mlp(spark, sf_dir):
    """``size`` is the bound on passes, ``depth`` the number of layers with weights."""
    train, valid = _parts(spark, sf_dir)
    learner = ml.network(PROFILE)
    prepared = ml.prepare(train, scale=True)
    model = ml.fit_on(prepared, learner)
    net = model.stages[-1]
    sizes = {"model": "mlp", "size": learner.passes, "depth": len(net.layers) + 1, "rows_to_fit": learner.rows_to_fit}
    losses = [watched for _, watched in net.curve]
    # The loss on watched rows falls, and training ends ``patience`` passes after the best or at the bound.
    ends = len(losses) == learner.passes or len(losses) == net.best_pass + learner.patience
    learned = {"loss_falls": losses[net.best_pass - 1] < losses[0] or net.best_pass == 1, "stops_as_stated": ends}
    checked = _holdout_check(model, prepared.dictionary, valid)
    return checked.select(*[F.lit(v).alias(k) for k, v in (sizes | learned).items()], "*")


@query("score_batch")
def q_score_batch(spark, sf_dir):
    return score(_clean(spark, sf_dir), rule_model(), _crop_dictionary(spark, sf_dir))


@query("score_modes")
def q_score_modes(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    found = []
    for mode in (RAW, ENCODED):
        model, dictionary = _trained(spark, sf_dir, mode=mode)
        checked = _score_check(score(clean, model, dictionary))
        found.append(checked.select(F.lit(score_mode(model)).alias("mode"), "rows", "unscored"))
    return found[0].unionByName(found[1])


@query("holdout_evaluation")
def q_holdout_evaluation(spark, sf_dir):
    """Supports of the report's rows, and whether the accuracy is above the larger class's share."""
    model, dictionary = _trained(spark, sf_dir, "random_forest")
    report = materialize(ml.evaluate_holdout(model, dictionary, _parts(spark, sf_dir)[1]), "report")
    larger = report.where(F.col("class").isin("0", "1")).agg((F.max("support") / F.sum("support")).alias("share"))
    good = (F.col("class") != "accuracy") | (F.col("f1") > F.col("share"))
    return report.crossJoin(F.broadcast(larger)).select("class", "support", good.alias("good"))


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    folded = sampling.stratified_folds(_stored_crop(spark, sf_dir))
    features = feature_projection(folded, "crop", keep=["fold"])
    summary = metrics.cv_summary(ml.cross_validate(ml.candidates(PROFILE, None), features))
    figures = [F.col(m) for m in ("f1", "precision", "recall", "roc_auc")]
    in_range = reduce(and_, [x.between(0, 1) for x in figures])
    good = (F.col("f1") > 0.8) & (F.col("roc_auc") > 0.9)
    return summary.select("model", "folds", in_range.alias("in_range"), good.alias("good"), F.lit(PROFILE).alias("profile"))


@query("best_model")
def q_best_model(spark, sf_dir):
    train, valid = _parts(spark, sf_dir)
    estimators = ml.candidates(PROFILE, None)
    fold_metrics = ml.cross_validate(estimators, sampling.stratified_folds(train))
    name, model, dictionary = ml.fit_best(estimators, fold_metrics, train)
    known = F.lit(name in estimators).alias("known")
    return _holdout_check(model, dictionary, valid).select(known, "*", F.lit(PROFILE).alias("profile"))


@query("variable_importance")
def q_variable_importance(spark, sf_dir):
    model, _ = _trained(spark, sf_dir, "random_forest")
    found = ml.variable_importance(model)
    whole = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9
    first = F.row_number().over(Window.orderBy(F.desc("importance"), "variable")) == 1  # six rows
    return found.select("variable", first.alias("first"), whole.alias("sums_to_one"))
