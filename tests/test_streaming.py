"""Streams against batches, replays, and the job as a whole."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from furrow.config import JobConfig, SourceConfig
from furrow.operators.encoding import fit_dictionary
from furrow.operators.features import feature_projection
from furrow.operators.readings import clean_readings, log_extract
from furrow.operators.scoring import score
from furrow.plans.bindings import crop, read_table, rule_model, sensor_envelope
from furrow.schemas import CATEGORY_FEATURES
from furrow.sources.artefacts import load_dictionary, load_model, save_dictionary, save_model
from furrow.sources.envelope import read_envelope
from furrow.sources.tables import read_predictions, readings_table, write_predictions, write_readings
from furrow.streaming import __main__ as program
from furrow.streaming import jobs
from tests.conftest import DATA, rows


@pytest.fixture(scope="module")
def envelope(spark):
    return sensor_envelope(read_table(spark, DATA, "events"))


@pytest.fixture(scope="module")
def dictionary(spark):
    return fit_dictionary(feature_projection(crop(spark, DATA), "crop"), CATEGORY_FEATURES)


@pytest.fixture
def cfg(envelope, path):
    """A job over a folder of five envelope files, read two at a time."""
    source = SourceConfig(format="parquet", path=path("topic"), max_files_per_trigger=2)
    envelope.select("key", "value").repartition(5).write.parquet(source.path)
    return JobConfig(
        source=source,
        readings_path=path("readings"),
        predictions_path=path("predictions"),
        checkpoint_root=path("checkpoints"),
        model_path=path("model"),
        dictionary_path=path("dictionary"),
        query_prefix=path("q").rsplit("/", 2)[1],
    )


def run(*queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


def same(left, right):
    right = right.select(*left.columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_stream_equals_batch(spark, cfg, envelope):
    clean = clean_readings(read_envelope(spark, cfg.source))
    run(jobs.start_readings(clean, cfg, available_now=True))
    same(readings_table(clean_readings(envelope)), spark.read.parquet(cfg.readings_path))


def test_both_designs_write_the_same_tables(spark, cfg, envelope, dictionary):
    clean = clean_readings(read_envelope(spark, cfg.source))
    run(jobs.start_fanout(clean, rule_model(), cfg, dictionary, available_now=True, show=None))
    own = dataclasses.replace(cfg, predictions_path=cfg.predictions_path + "-own", readings_path=cfg.readings_path + "-own")
    run(jobs.start_predictions(clean, rule_model(), own, dictionary, available_now=True))
    fanned = spark.read.parquet(cfg.predictions_path)
    assert fanned.select("batch_id").distinct().count() == 3
    same(spark.read.parquet(own.predictions_path), read_predictions(spark, cfg.predictions_path))


def test_resume_adds_only_new_rows(spark, cfg, envelope):
    clean = clean_readings(read_envelope(spark, cfg.source))
    total = envelope.count()
    for _ in range(2):
        run(jobs.start_readings(clean, cfg, available_now=True))
        assert spark.read.parquet(cfg.readings_path).count() == total
    envelope.select("key", "value").limit(7).coalesce(1).write.mode("append").parquet(cfg.source.path)
    run(jobs.start_readings(clean, cfg, available_now=True))
    assert spark.read.parquet(cfg.readings_path).count() == total + 7


def test_replayed_batch_leaves_each_row_once(spark, cfg, envelope, dictionary):
    clean = clean_readings(envelope)
    other = clean.limit(10)
    for batch_id, batch in ((0, clean), (1, other), (0, clean)):
        jobs.fanout_batch(batch, batch_id, rule_model(), cfg, dictionary, show=None)
    for table in (cfg.readings_path, cfg.predictions_path):
        assert spark.read.parquet(table).count() == clean.count() + 10


def test_replay_after_a_failure_between_the_tables(spark, cfg, envelope, dictionary, monkeypatch):
    clean = clean_readings(envelope)

    def broken(*args):
        raise RuntimeError("scoring failed")

    with monkeypatch.context() as m:
        m.setattr(jobs, "score", broken)
        with pytest.raises(RuntimeError):
            jobs.fanout_batch(clean, 0, rule_model(), cfg, dictionary, show=None)
    jobs.fanout_batch(clean, 0, rule_model(), cfg, dictionary, show=None)
    assert spark.read.parquet(cfg.readings_path).count() == clean.count()
    assert spark.read.parquet(cfg.predictions_path).count() == clean.count()


def test_rows_without_a_date_keep_their_partition(spark, cfg, envelope):
    write_readings(clean_readings(envelope), cfg.readings_path)
    table = spark.read.parquet(cfg.readings_path)
    undated = clean_readings(envelope).where("ts IS NULL").count()
    assert undated > 0 and table.where("date IS NULL").count() == undated
    assert any("__HIVE_DEFAULT_PARTITION__" in f for f in table.inputFiles())


def test_batch_append_of_predictions(spark, cfg, envelope, dictionary):
    scored = score(clean_readings(envelope), rule_model(), dictionary)
    for _ in range(2):
        write_predictions(scored, cfg.predictions_path)
    table = spark.read.parquet(cfg.predictions_path)
    assert table.count() == 2 * scored.count()
    assert dict(table.dtypes)["needsIrrigation"] == "bigint"


def test_empty_batch_writes_nothing(spark, cfg, envelope, dictionary, tmp_path):
    jobs.fanout_batch(clean_readings(envelope.limit(0)), 0, rule_model(), cfg, dictionary)
    assert not (tmp_path / "readings").exists()


def test_console_shows_rows_untruncated(spark, cfg, capsys):
    clean = clean_readings(read_envelope(spark, cfg.source)).withColumn("cropId", F.lit("x" * 40))
    run(jobs.start_console(clean, dataclasses.replace(cfg, console_rows=3), available_now=True))
    text = capsys.readouterr().out
    assert "batch 0" in text and "x" * 40 in text and "only showing top 3 rows" in text


def test_all_null_text_columns_are_scored(spark, cfg, dictionary):
    env = spark.createDataFrame([(None, None)] * 4, "key binary, value binary")
    scored = score(clean_readings(env), rule_model(), dictionary)
    assert [r.needsIrrigation for r in scored.collect()] == [1] * 4
    assert dict(scored.dtypes)["cropId"] == "string"


def test_job_fails_before_it_starts_without_a_model(spark, cfg):
    before = len(spark.streams.active)
    with pytest.raises(RuntimeError, match="cannot load the model"):
        jobs.run_stream(spark, cfg, available_now=True)
    assert len(spark.streams.active) == before


def test_job_fails_without_a_needed_dictionary(spark, cfg):
    save_model(rule_model(), cfg.model_path)
    with pytest.raises(RuntimeError, match="dictionary"):
        jobs.run_stream(spark, cfg, available_now=True)
    assert load_dictionary(spark, cfg.dictionary_path, required=False) is None


@pytest.mark.parametrize("fanout", [True, False])
def test_whole_job(spark, cfg, envelope, dictionary, fanout):
    save_model(rule_model(), cfg.model_path)
    save_dictionary(dictionary, cfg.dictionary_path)
    queries = jobs.run_stream(spark, cfg, available_now=True, fanout=fanout)
    assert {q.name for q in queries} >= {cfg.query_name("console")}
    run(*queries)
    want = score(clean_readings(envelope), load_model(cfg.model_path), dictionary)
    got = spark.read.parquet(cfg.predictions_path)
    columns = ["deviceId", "ts", "stage", "moisturePct", "needsIrrigation"]
    same(want.select(columns), got.select(columns))
    assert rows(spark.read.parquet(cfg.readings_path).groupBy().count()) == [(envelope.count(),)]


@pytest.mark.parametrize("gather", [True, False])
def test_a_hot_date_is_split_and_others_are_gathered(spark, cfg, path, gather):
    """A third of the rows share one date; files follow size, not tasks times dates."""
    ids = spark.range(0, 60000, 1, 12)
    second = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20 * 86400)
    payload = F.struct(
        F.date_format(F.timestamp_seconds(second + 1700000000), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("cropId"),
    )
    source = SourceConfig(format="parquet", path=path("hot"))
    key = F.col("id").cast("string").cast("binary")
    env = ids.select(key.alias("key"), F.to_json(payload).cast("binary").alias("value"))
    env.write.parquet(source.path)
    # Small splits, so that several tasks see every date, and partitions enough to part most dates.
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.files.maxPartitionBytes": "600KB",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        clean = clean_readings(read_envelope(spark, source))
        run(jobs.start_readings(clean, dataclasses.replace(cfg, gather_dates=gather), available_now=True))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    table = spark.read.parquet(cfg.readings_path)
    files = table.select("date", F.col("_metadata.file_path").alias("file")).groupBy("date")
    files = files.agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows"))
    found = files.orderBy(F.desc("rows")).collect()
    assert sum(r.rows for r in found) == 60000 and len(found) == 20
    if gather:
        assert found[0].files > 1 and sum(r.files for r in found[1:]) <= 2 * 19
    else:
        assert sum(r.files for r in found[1:]) > 3 * 19


def test_runs_add_to_each_other(spark, cfg, envelope, dictionary):
    clean = clean_readings(envelope)
    second = dataclasses.replace(cfg, run_id="second")
    for run_cfg, batch in ((cfg, clean), (second, clean.limit(30)), (cfg, clean), (second, clean.limit(30))):
        jobs.fanout_batch(batch, 0, rule_model(), run_cfg, dictionary, show=None)
    for table in (cfg.readings_path, cfg.predictions_path):
        assert spark.read.parquet(table).count() == clean.count() + 30


def test_writers_refuse_each_others_tables(spark, cfg, envelope, dictionary):
    stream, clean = clean_readings(read_envelope(spark, cfg.source)), clean_readings(envelope)
    run(jobs.start_readings(stream, cfg, available_now=True))
    with pytest.raises(ValueError, match="native stream"):
        write_readings(clean, cfg.readings_path)
    with pytest.raises(ValueError, match="native stream"):
        jobs.start_fanout(stream, rule_model(), cfg, dictionary, available_now=True)
    fanned = dataclasses.replace(cfg, readings_path=cfg.readings_path + "-f", run_id="f")
    run(jobs.start_fanout(stream, rule_model(), fanned, dictionary, available_now=True, show=None))
    with pytest.raises(ValueError, match="native stream"):
        jobs.start_readings(stream, fanned, available_now=True)
    assert spark.read.parquet(fanned.readings_path).count() == clean.count()


def test_a_batch_is_scored_once_and_the_shown_rows_apart(spark, cfg, envelope, dictionary, monkeypatch):
    clean, sizes, shown = clean_readings(envelope), [], []

    def counted(df, *args):
        sizes.append(df.count())
        return score(df, *args)

    monkeypatch.setattr(jobs, "score", counted)
    jobs.fanout_batch(clean, 0, rule_model(), cfg, dictionary, show=lambda df, *_: shown.extend(df.collect()))
    assert sizes == [clean.count(), 50]
    whole = log_extract(score(clean, rule_model(), dictionary)).collect()
    assert sorted(map(str, shown)) == sorted(map(str, whole))


def test_the_program_waits_until_a_query_ends(spark, cfg, envelope, dictionary, monkeypatch):
    save_model(rule_model(), cfg.model_path)
    save_dictionary(dictionary, cfg.dictionary_path)
    started = []

    def run_stream(*args, **options):
        started.extend(jobs.run_stream(*args, **options, available_now=True))

    spark.streams.resetTerminated()
    monkeypatch.setattr(program, "build_session", lambda name: spark)
    monkeypatch.setattr(program.JobConfig, "from_env", classmethod(lambda cls: cfg))
    monkeypatch.setattr(program, "run_stream", run_stream)
    monkeypatch.setattr(program.sys, "argv", ["furrow.streaming"])
    program.main()
    assert any(not q.isActive for q in started)
    run(*started)
    assert spark.read.parquet(cfg.readings_path).count() == envelope.count()


def test_a_batch_fills_its_cache_in_all_tasks_at_once(spark, cfg, envelope, dictionary, monkeypatch):
    """Every part is cached by one job before the first write, not one part by a look for a row."""
    seen, keep = [], jobs.replace_batch

    def watched(*args):
        seen.append([(info.numCachedPartitions(), info.numPartitions()) for info in spark.sparkContext._jsc.sc().getRDDStorageInfo()])
        return keep(*args)

    monkeypatch.setattr(jobs, "replace_batch", watched)
    jobs.fanout_batch(clean_readings(envelope.repartition(7)), 0, rule_model(), cfg, dictionary, show=None)
    assert (7, 7) in seen[0]
