from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken

from furrow.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Encoder(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


ODD = [
    "", " ", "\n\n  x", "a" * 1000, "ab" * 500 + "!" * 70, "é" * 90, "日本語" * 40, "😀‍" * 30, "it's we'll 12345 ñ\r\n\t z",
    "<|endoftext|>", "x" * 65, "y" * 64, "Thntblere of thtionsh " * 9, "  \x1c\x85.", "́e" * 20,
]


def test_like_the_library(own, library):
    assert own.encode(ODD) == [" ".join(map(str, library.encode_ordinary(t))) for t in ODD]


def test_every_character_in_context(own, library):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert own.encode(texts) == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]


def test_one_tree_and_many_trees_agree(own):
    pieces = [p.encode() for t in ODD for p in own.find(t)]
    assert [" ".join(map(str, own.encode_long(p))) for p in pieces if p not in own.ranks] == [
        ids for p, ids in zip(pieces, own.encode_pieces(pieces)) if p not in own.ranks
    ]


def test_the_cache_may_be_small(own, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    texts = [f"wörd{i} other{i % 5} the" for i in range(50)]
    for _ in range(2):
        assert [own.encode([t])[0] for t in texts] == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]


def test_tables(spark, docs, clashing, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TEXT_AT_ONCE", 100)
    rows = [*enumerate(ODD), (90, None), (90, None), (None, "z")]
    got = byte_bpe.round_trip(clashing(rows), PATH, PATTERN).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], bytes(r["decoded"]).decode()) for r in got if r["doc_id"] is not None) == sorted(
        (False, i, t or "") for i, t in rows if i is not None
    )
    apart = byte_bpe.decode(byte_bpe.encode(docs(rows), PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(map(str, apart)) == sorted(map(str, got))
    assert byte_bpe.round_trip(docs([]), PATH, PATTERN).count() == 0


def test_whole_table_round_trip(spark, library):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    for r in byte_bpe.round_trip(table, PATH, PATTERN).collect():
        text = texts[r["doc_id"]]
        assert bytes(r["decoded"]) == text.encode()
        assert r["ids"] == " ".join(map(str, library.encode_ordinary(text)))
