"""Compaction of date partitions beside a running stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from furrow.sources import tables
from furrow.sources.tables import COMPACTED, compact_dates, live_rows, replace_batch

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", None]


@pytest.fixture
def batch(spark):
    """A function from a batch id to its rows: two of each day."""

    def make(number, run="a"):
        rows = [(f"{run}-{number}-{day}-{i}", day) for day in DAYS for i in range(2)]
        return spark.createDataFrame(rows, "name string, day string").select("name", F.col("day").cast("date").alias("date"))

    return make


def names(spark, path):
    return sorted(r["name"] for r in live_rows(spark, path).collect())


def parts(spark, path):
    found = live_rows(spark, path).groupBy(F.col("date").cast("string").alias("date")).agg(F.countDistinct("run_id", "batch_id"))
    return dict(map(tuple, found.collect()))


def folders(spark, path):
    return spark.read.parquet(path).select("date", "run_id", "batch_id").distinct().count()


def test_closed_dates_become_one_partition(spark, batch, path):
    table = path("t")
    for k in range(3):
        replace_batch(batch(k), table, k)
    replace_batch(batch(0, "b"), table, 0, run_id="run b: 1/2")
    want = names(spark, table)
    assert len(want) == 32 and parts(spark, table) == dict.fromkeys(DAYS, 4)
    assert compact_dates(spark, table, "2024-01-03") == 8
    assert names(spark, table) == want
    assert parts(spark, table) == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 4, None: 4}
    assert folders(spark, table) == 10  # the sources are gone
    assert compact_dates(spark, table, "2024-01-03") == 0 and names(spark, table) == want


def test_replays_and_late_rows(spark, batch, path):
    table = path("t")
    for k in range(2):
        replace_batch(batch(k), table, k)
    compact_dates(spark, table, "2024-01-03")
    replace_batch(batch(1), table, 1)  # a replay of a batch that was compacted
    replace_batch(batch(2), table, 2)  # rows that arrive late
    want = sorted(r["name"] for k in range(3) for r in batch(k).collect())
    assert names(spark, table) == want
    assert parts(spark, table)["2024-01-01"] == 2
    assert compact_dates(spark, table, "2024-01-03") == 4  # for each date the late rows and the compacted ones
    assert names(spark, table) == want and parts(spark, table)["2024-01-01"] == 1
    replace_batch(batch(0), table, 0)
    replace_batch(batch(2), table, 2)
    assert names(spark, table) == want


class Broken(Exception):
    pass


@pytest.mark.parametrize("stop", ["before the manifest", "before the deletion"])
def test_a_compaction_that_breaks_off_changes_nothing(spark, batch, path, monkeypatch, stop):
    table = path("t")
    for k in range(3):
        replace_batch(batch(k), table, k)
    want, calls = names(spark, table), []

    def broken(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise Broken

    with monkeypatch.context() as patch:
        if stop == "before the manifest":
            patch.setattr(tables, "COMPACTIONS", "date=x/a\0b")  # a folder that cannot be written
            with pytest.raises(Exception):
                compact_dates(spark, table, "2024-01-03")
            assert folders(spark, table) == 14  # its rows are there, beside their sources
        else:
            patch.setattr(tables, "_clear", broken)
            with pytest.raises(Broken):
                compact_dates(spark, table, "2024-01-03")
    assert names(spark, table) == want
    assert compact_dates(spark, table, "2024-01-03") == (6 if stop == "before the manifest" else 0)
    assert names(spark, table) == want and parts(spark, table)["2024-01-02"] == 1 and folders(spark, table) == 8


def test_what_is_not_compacted(spark, batch, path):
    with pytest.raises(ValueError, match="compacted rows"):
        replace_batch(batch(0), path("t"), 0, run_id=COMPACTED + "x")
    batch(0).write.partitionBy("date").parquet(path("plain"))
    assert live_rows(spark, path("plain")).count() == 8
    with pytest.raises(ValueError, match="no partitions"):
        compact_dates(spark, path("plain"), "2024-01-03")
