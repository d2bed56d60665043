from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from furrow.llm import piece_bpe, queries
from tests.llm import plain

PATH = public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.001"
ODD = [
    "", " ", "a", " a", "  a b  ", "a\n b", "▁x", "\x00z", "<0x41><s></s><unk>", "日本語" * 30, "ﬁ①", "​﻿ x",
    " " * 100, "x" + " " * 33 + "y", "a\xa0b", "é́" * 20, "😀‍" * 20, "ab" * 3000, "a" * 5000, "Thntblere of thtionsh " * 9, "\t\r\n ",
]


@pytest.fixture(scope="module")
def own():
    return piece_bpe.coder(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def by_library(library, text):
    return " ".join(map(str, library.encode(text, add_eos=True)))


def test_like_the_library(own, library):
    assert own.encode(ODD, 2) == [by_library(library, t) for t in ODD]
    assert [own.decode(ids) for ids in own.encode(ODD, 2)] == [library.decode(library.encode(t, add_eos=True)) for t in ODD]
    assert own.encode([""]) == [""] and own.decode("") == ""


def test_texts_are_cut_where_no_piece_reaches_across(own, library):
    text = "reanst!! (reanst) Привет, 日本 1.5"
    assert own.find("▁" + text.replace(" ", "▁"))[:5] == ["▁reanst", "!!", "▁(", "reanst", ")"]
    assert own.encode([text], 2) == [by_library(library, text)]
    beside = {a + b for piece in own.ids for a, b in zip(piece.strip("▁"), piece.strip("▁")[1:])}
    classes = piece_bpe._classes(own.ids)
    assert len(classes) == piece_bpe.CLASSES and all(any(set(pair) <= c for c in classes) for pair in beside)


def test_bytes_among_pieces(own, library):
    rng = random.Random(8)
    tokens, known = list(own.bytes.values()), range(library.vocab_size())
    for _ in range(20_000):
        ids = [rng.choice(tokens if rng.random() < 0.6 else known) for _ in range(rng.randint(1, 8))]
        assert own.decode(" ".join(map(str, ids))) == library.decode(ids)


def test_parts_are_remembered_for_two_generations(monkeypatch, library):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 50)
    own = piece_bpe.Coder(PATH)
    texts = [" ".join(f"word{i % 7}x q{i}z" for i in range(300)) + "y" * 300 for _ in range(3)]
    assert own.encode(texts, 2) == [by_library(library, t) for t in texts]
    assert len(own.known) <= 51 and len(own.known.old) <= 51 and "y" * 300 not in own.known


def test_every_character_in_context(own, library):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert own.encode(texts, 2) == [by_library(library, t) for t in texts]


def test_pieces_side_by_side(own, library):
    rng = random.Random(12)
    pieces = own.model.pieces[259:]
    texts = ["".join(rng.choices(pieces, k=rng.randint(2, 7))).replace("▁", " ") for _ in range(20_000)]
    assert own.encode(texts, 2) == [by_library(library, t) for t in texts]


def test_the_table_agrees_with_merging_one_by_one(own):
    rng = random.Random(2)
    for _ in range(3_000):
        part = "".join(rng.choices("▁▁aetionsrdlh①", k=rng.randint(1, 14)))
        tokens = own._merged(part)[0]
        want = [i for c, t in zip(_spans(own, part, tokens), tokens) for i in ([t] if t >= 0 else own.encode_part(c))]
        assert own.encode_part(part) == want


def _spans(own, part, tokens):
    at = 0
    for t in tokens:
        size = 1 if t < 0 else len(own.model.pieces[t])
        yield part[at : at + size]
        at += size


def test_both_tests_of_a_pair_agree(own):
    rng = random.Random(7)
    ordered = [i for i, good in own.ordered.items() if good]
    for _ in range(20_000):
        left, right = rng.choices(ordered, k=2)
        merged = own._merged(own.model.pieces[left] + own.model.pieces[right])[0]
        assert own.stay_two(left, right) == (merged == [left, right])


def test_decoding_any_ids(own, library):
    rng = random.Random(4)
    kinds = [lambda: rng.randrange(3), lambda: rng.randrange(3, 259), lambda: rng.randrange(259, 300), lambda: rng.randrange(32_000)]
    for _ in range(5_000):
        ids = [rng.choice(kinds)() for _ in range(rng.randint(0, 9))]
        assert own.decode(" ".join(map(str, ids))) == library.decode(ids)


def test_the_caches_may_be_small(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(piece_bpe, "REMEMBERED_PAIRS", 5)
    monkeypatch.setattr(piece_bpe, "LONGEST_REMEMBERED", 6)
    small = piece_bpe.Coder(PATH)
    texts = [f"wörd{i} other{i % 5} the\n" for i in range(50)]
    for _ in range(2):
        assert [small.encode([t], 2)[0] for t in texts] == [by_library(library, t) for t in texts]


def test_other_files_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        data = file.read()
    rules = data.rfind(b"identity")
    assert data[rules + 8 : rules + 12] == b"\x12\x00\x18\x01"
    other = tmp_path / "other.model"
    other.write_bytes(data[: rules + 12] + b"\x20\x01" + data[rules + 14 :])  # that drops repeated blanks
    with pytest.raises(ValueError):
        piece_bpe.Coder(str(other))


def test_tables(spark, docs, clashing):
    rows = [*enumerate(ODD), (90, None), (90, None), (None, "z")]
    got = piece_bpe.round_trip(clashing(rows), PATH, 2).collect()
    assert len(got) == len(rows) and {r["ids"] for r in got if r["doc_id"] == 90} == {"2"}
    apart = piece_bpe.decode(piece_bpe.encode(docs(rows), PATH, 2), PATH).collect()
    assert sorted(map(str, apart)) == sorted(map(str, got))
    assert piece_bpe.round_trip(docs([]), PATH).count() == 0


def test_op12(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op12_sentencepiece(spark, DATA).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        ids, r = library.encode(text, add_eos=True), got[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == plain.sha256(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == plain.sha256(library.decode(ids))
