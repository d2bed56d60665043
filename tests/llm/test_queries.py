"""The queries that SQL cannot express, against plain Python over whole small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from furrow.llm import byte_bpe, license_scan, queries
from tests.llm import plain

DATA = "/root/testdata/sf0.001"


def crc(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def rows(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def test_op2(spark, texts):
    got = {r["doc_id"]: r for r in rows(spark, "op2_quality")}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r["held_out"] == (crc(i, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_op4(spark, texts):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op4_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = np.array([*own.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for own_rows in sequences.values():
        at = 0
        for r in sorted(own_rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_op6(spark, texts):
    own = byte_bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for r in rows(spark, "op6_byte_bpe"):
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == plain.sha256(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_op7(spark, texts):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in rows(spark, "op7_language_id")}
    assert set(got) == set(texts) and all(r["held_out"] == (crc(i, 4) == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([got[i]["lang_pred"] == langs[i] for i in held]) > 0.95


def test_op9(spark, texts):
    got = sorted((r["doc_id"], r["license"], r["start"], r["end"]) for r in rows(spark, "op9_license_scan"))
    prepared = license_scan.prepare(license_scan.TEMPLATES, license_scan.LEAST_COVERAGE)
    want = []
    for i, text in texts.items():
        spans = [(m.group().lower(), m.start(), m.end()) for m in license_scan.WORD.finditer(text)]
        for t in prepared:  # every template, without the test for its keys
            for a, b, _ in license_scan.matches([w for w, _, _ in spans], t):
                want.append((i, t.name, spans[a][1], spans[b - 1][2]))
    assert got == sorted(want) and got
