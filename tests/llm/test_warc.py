from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from furrow.llm import warc

SCHEMA = "page_id long, url string, html string, content string, key string, record string, revisit string"


@pytest.fixture
def written(spark, path):
    def run(rows, **options):
        table = spark.createDataFrame([(*r, "c", "k", "r", "v") for r in rows], SCHEMA)
        warc.write_pages(table, path("archive"), **options)
        return warc.read_archive(spark, path("archive"))

    return run


def test_round_trip_in_segments_and_chunks(written, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 300)
    monkeypatch.setattr(warc, "CHUNK", 70)
    random.seed(1)
    rows = [(i, f"http://h/{i} ä\r\nX: y", "".join(random.choice("aé\r\n😀0<") for _ in range(random.randint(0, 900)))) for i in range(60)]
    rows += [(100, None, None), (101, "http://e", "\r\n\r\nWARC/1.1\r\n\r\n"), (102, "", rows[5][2]), (103, "u", "")]
    got = {r["page_id"]: r for r in written(rows).collect()}
    assert len(got) == len(rows) and {r["status"] for r in got.values()} == {"ok"}
    first = {}
    for i, _, html in sorted(rows):
        payload = (html or "").encode()
        assert got[i]["payload_digest"] == warc.payload_digest(payload)
        if first.setdefault(payload, i) == i:
            assert got[i]["record_type"] == "response" and bytes(got[i]["payload"]) == payload
        else:
            assert got[i]["record_type"] == "revisit" and got[i]["payload"] is None


def test_resolved_revisits(written):
    rows = [(9, "a", "same"), (2, "b", "same"), (5, "c", "same"), (4, "d", "x"), (None, "e", "same"), (2, "f", "same")]
    got = warc.resolve_revisits(written(rows)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["payload_bytes"], r["refers_to"]) for r in got) == [
        ("2", "response", 4, None), ("2", "response", 4, None), ("4", "response", 1, None), ("5", "revisit", 4, 2),
        ("9", "revisit", 4, 2), ("None", "response", 4, None),
    ]


def test_small_payloads_are_not_revisited(written):
    rows = [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]
    kinds = {r["page_id"]: r["record_type"] for r in written(rows, least_revisit=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table_and_plain_files(spark, path, written):
    assert written([]).count() == 0
    table = spark.createDataFrame([(1, "u", "p" * 50)], "page_id long, url string, html string")
    warc.write_pages(table, path("plain"), compression="none")
    assert [bytes(r["payload"]) for r in warc.read_archive(spark, path("plain")).collect()] == [b"p" * 50]


def archive(spark, tmp_path, *records, zipped=False):
    """A file of records, read back; each in a gzip member of its own if zipped."""
    data = [r + b"\r\n\r\n" for r in records]
    tmp_path.joinpath("part-0").write_bytes(b"".join(gzip.compress(d) for d in data) if zipped else b"".join(data))
    return warc.read_archive(spark, f"file://{tmp_path}").collect()


@pytest.mark.parametrize("zipped", [False, True])
def test_segments_in_any_order(spark, tmp_path, zipped, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 100)
    records = list(warc.page_records(7, "u", b"payload " * 90, False))
    assert len(records) > 5
    (row,) = archive(spark, tmp_path, *records[::-1], zipped=zipped)
    assert (row["page_id"], row["status"], bytes(row["payload"])) == (7, "ok", b"payload " * 90)


def test_what_is_not_whole_is_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 100)
    records = list(warc.page_records(7, "u", b"payload " * 90, False))
    for kept in (records[:3] + records[4:], records[:-1]):
        (row,) = archive(spark, tmp_path, *kept)
        assert row["status"] == "incomplete" and row["payload"] is None
    assert archive(spark, tmp_path, *records[1:]) == []


def test_broken_framing_and_digest(spark, tmp_path):
    (record,) = warc.page_records(1, "u", b"hello world", False)
    (row,) = archive(spark, tmp_path, record.replace(b"\r\nb\r\n", b"\r\nc\r\n"))
    assert row["status"] == "damaged"
    (row,) = archive(spark, tmp_path, record.replace(b"hello", b"jello"))
    assert row["status"] == "wrong digest"
    (row,) = archive(spark, tmp_path, record, b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 999\r\n\r\ncut")
    assert row["status"] == "ok"
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.unchunked(b"zz\r\n") is None


def test_reading_faults_fail_the_query_and_digests_are_of_what_was_read(spark, tmp_path, monkeypatch):
    (record,) = warc.page_records(1, "u", b"hello world", False)
    (row,) = archive(spark, tmp_path, record.replace(b"hello", b"jello"))
    assert row["payload_digest"] == warc.payload_digest(b"jello world")
    monkeypatch.setattr(warc, "SEGMENT", 100)
    segments = list(warc.page_records(7, "u", b"payload " * 90, False))
    faults = {
        "wrong digest": [record.replace(b"hello", b"jello")],
        "damaged": [record.replace(b"\r\nb\r\n", b"\r\nc\r\n")],
        "incomplete": segments[:3] + segments[4:],
    }
    for status, records in faults.items():
        (row,) = archive(spark, tmp_path, *records)
        assert row["status"] == status and (status == "wrong digest" or row["payload_digest"] is None)
        with pytest.raises(Exception, match=status):
            warc.resolve_revisits(warc.read_archive(spark, f"file://{tmp_path}")).collect()


def test_a_common_payload_is_grouped_before_it_moves(spark, written):
    rows = [(i, "u", "common" if i % 3 == 0 else str(i)) for i in range(300)]
    kinds = written(rows).groupBy("record_type").agg(F.count(F.lit(1)).alias("n"))
    assert dict(map(tuple, kinds.collect())) == {"response": 201, "revisit": 99}
