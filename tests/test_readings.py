"""Payload defects and normalisation rules."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furrow.functions.text import fill_missing, seedling_flag, strip
from furrow.operators.readings import (
    clean_readings,
    coerce_numeric,
    decode_envelope,
    harmonize_moisture,
    head_rows,
    is_empty,
    log_extract,
)
from furrow.sources.envelope import encode_envelope, raw_tap
from furrow.sources.tables import readings_table

FULL = {
    "deviceId": "dev-7", "ts": "2025-01-02T03:04:05Z", "cropId": "maize", "soilType": "clay", "stage": "Seedling",
    "soilMoisture": 0.3, "tempC": 20.5, "humidity": 61,
}


def envelope(spark, *records):
    """Records are (key, value) with value a dict, a text or None."""
    data = []
    for key, value in records:
        text = json.dumps(value) if isinstance(value, dict) else value
        data.append((key and key.encode(), None if text is None else text.encode()))
    return spark.createDataFrame(data, "key binary, value binary")


def clean_one(spark, value, key="k"):
    return clean_readings(envelope(spark, (key, value)), with_status=True).first()


def test_full_payload(spark):
    row = clean_one(spark, FULL)
    assert (row.deviceId, row.cropId, row.soilType, row.stage) == ("dev-7", "maize", "clay", "Seedling")
    assert row.ts == row.event_time == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert (row.moisture01, row.moisturePct, row.tempC, row.humidity) == (0.3, 30.0, 20.5, 61.0)
    assert row.decode_status == "ok"


@pytest.mark.parametrize(
    ("value", "status"), [('{"deviceId":', "malformed"), ("plain words", "malformed"), (None, "empty"), ("", "empty")]
)
def test_unreadable_payload_keeps_the_row(spark, value, status):
    row = clean_one(spark, value)
    assert row.deviceId == "k"
    assert row.ts is None and row.tempC is None and row.moisture01 is None
    assert row.decode_status == status


def test_wrong_type_spoils_only_its_field(spark):
    row = clean_one(spark, {**FULL, "tempC": "22.1"})
    assert row.tempC is None and row.humidity == 61.0 and row.deviceId == "dev-7"
    assert row.decode_status == "partial"


def test_field_names_are_case_sensitive(spark):
    assert clean_one(spark, {"DeviceId": "x", "tempC": 1}).deviceId == "k"


def test_nested_object_in_text_field_is_kept_as_text(spark):
    assert json.loads(clean_one(spark, {**FULL, "cropId": {"a": 1}}).cropId) == {"a": 1}


def test_nan_token(spark):
    assert math.isnan(clean_one(spark, '{"tempC": NaN}').tempC)


def test_array_payload_keeps_the_row(spark):
    assert clean_readings(envelope(spark, ("k", '[{"tempC": 1}]'))).count() == 1


def test_null_key_and_device(spark):
    assert clean_one(spark, {"tempC": 1}, key=None).deviceId is None


def test_bad_time_is_null_and_has_no_date(spark):
    df = readings_table(clean_readings(envelope(spark, ("k", {**FULL, "ts": "soon"}))))
    row = df.first()
    assert row.ts is None and row.date is None


def test_moisture_rule(spark):
    df = spark.createDataFrame(
        [(0.4, 70.0), (None, 70.0), (None, None), (1.7, None), (float("nan"), 10.0)],
        "soilMoisture double, moistureIdx double",
    )
    got = [r.moisture01 for r in harmonize_moisture(df).collect()]
    assert got[:4] == [0.4, 0.7, None, 1.7]
    assert math.isnan(got[4])


def test_status_does_not_change_the_fields(spark):
    env = envelope(spark, ("a", FULL), ("b", {**FULL, "tempC": "x"}), ("c", "oops"), ("d", None), ("e", "[1]"))
    plain = decode_envelope(env)
    assert plain.collect() == decode_envelope(env, with_status=True).drop("decode_status").collect()


def test_coerce_numeric(spark):
    texts = ["22.5", " 7 ", "1e3", "-.5", "12d", "0x1p3", "", "bad", "nan", "inf", None]
    df = spark.createDataFrame([(t, 3) for t in texts], "a string, b int")
    got = [tuple(r) for r in coerce_numeric(df, ["a", "b"]).collect()]
    want = [22.5, 7.0, 1000.0, -0.5, None, None, None, None, None, math.inf, None]
    assert got == [(w, 3.0) for w in want]


def test_strip_and_flags(spark):
    texts = [" a ", "\t\n Seedling\r\n", "SEEDLING ", "\xa0b ", "seedlings", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(strip("t"), seedling_flag("t"), fill_missing("t")).collect()
    assert [r[0] for r in got] == [None if t is None else t.strip() for t in texts]
    assert [r[1] for r in got] == ["No", "Yes", "Yes", "No", "No", "No"]
    assert got[-1][2] == "missing"


def test_raw_tap_shows_gaps(spark):
    lines = [r.line for r in raw_tap(envelope(spark, ("k", "v"), (None, "v"), ("k", None), ("k", ""))).collect()]
    assert lines == ["k:v", "None:v", "k:None", "k:None"]


def test_log_extract_orders_by_time_nulls_last(spark):
    data = [("b", None), ("c", dt.datetime(2025, 1, 2)), ("a", dt.datetime(2025, 1, 2)), ("d", dt.datetime(2025, 1, 1))]
    df = spark.createDataFrame(data, "deviceId string, ts timestamp").selectExpr(
        "ts", "deviceId", "'x' cropId", "'s' stage", "1d moisturePct", "1d tempC", "1d humidity", "1L needsIrrigation"
    )
    assert [r.deviceId for r in log_extract(df, 4).collect()] == ["d", "a", "c", "b"]
    assert log_extract(df, 2).count() == 2


def test_head_and_empty(spark):
    df = spark.range(10)
    assert [r.id for r in head_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert is_empty(df.where("id < 0")) and not is_empty(df)


texts = st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=8)
numbers = st.floats(allow_nan=False, allow_infinity=False, width=32)
payloads = st.fixed_dictionaries(
    {},
    optional={
        "deviceId": texts, "ts": texts, "cropId": texts, "soilType": texts, "stage": texts,
        "soilMoisture": numbers, "moistureIdx": numbers, "tempC": numbers, "humidity": numbers,
    },
)
slow = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@slow
@given(st.lists(st.one_of(payloads, texts, st.none()), min_size=1, max_size=20))
def test_decode_never_loses_a_row(spark, values):
    df = clean_readings(envelope(spark, *[(f"k{i}", v) for i, v in enumerate(values)]))
    found = df.select("moisture01", "moisturePct").collect()
    assert len(found) == len(values)
    assert all(r[0] is None or r[1] == r[0] * 100.0 for r in found)


@slow
@given(st.lists(payloads, min_size=1, max_size=20))
def test_encode_then_decode(spark, values):
    first = decode_envelope(envelope(spark, *[(f"k{i}", v) for i, v in enumerate(values)])).withColumnRenamed(
        "ts_raw", "ts"
    )
    again = decode_envelope(encode_envelope(first)).withColumnRenamed("ts_raw", "ts")
    assert sorted(map(str, first.collect())) == sorted(map(str, again.select(first.columns).collect()))


def test_encode_leaves_out_null_fields(spark):
    fields = decode_envelope(envelope(spark, ("k", {"tempC": 1.5}))).withColumnRenamed("ts_raw", "ts")
    row = encode_envelope(fields).select(F.col("key").cast("string"), F.col("value").cast("string")).first()
    assert row[0] == "k" and json.loads(row[1]) == {"deviceId": "k", "tempC": 1.5}
