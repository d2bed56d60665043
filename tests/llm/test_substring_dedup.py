from __future__ import annotations

import random

import numpy as np
import pytest

from furrow.llm import substring_dedup, tables
from tests.llm import plain


def found(df, **options):
    return {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, **options).collect()}


def check(rows, got, width):
    for doc_id, (n, kept) in plain.without_repeats(rows, width).items():
        row = got[doc_id]
        assert (row["n_words"], row["n_removed"]) == (n, n - len(kept)), doc_id
        assert bytes(row["kept"]).decode() == " ".join(kept)


@pytest.mark.parametrize("width", [1, 2, 3, 5, 20, 31])
def test_window_hashes_are_the_polynomial(width):
    words = np.random.default_rng(1).integers(0, 2**63, 40).astype(np.uint64)
    got = tables.window_hashes(words, width, substring_dedup.BASE)
    want = [
        sum(int(words[i + k]) * pow(substring_dedup.BASE, width - 1 - k, 1 << 64) for k in range(width)) % (1 << 64)
        for i in range(40 - width + 1)
    ]
    assert got.tolist() == want


def test_against_plain_python(docs, monkeypatch):
    """Few words and short windows, so that nearly everything repeats, over many blocks, buckets and parts."""
    random.seed(5)
    monkeypatch.setattr(substring_dedup, "BLOCK", 40)
    monkeypatch.setattr(substring_dedup, "BUCKET", 60)
    monkeypatch.setattr(substring_dedup, "PART", 50)
    passage = " ".join(random.choice("abcdefgh") for _ in range(30))
    rows = []
    for i in range(120):
        text = " ".join(random.choice("abcdefgh") for _ in range(random.randint(0, 40)))
        if i % 3 == 0:
            text = f"{text}\n{passage}\t{text[:9]}"
        rows.append((i * 7 % 121, text))
    check(rows, found(docs(rows).repartition(6), width=6), 6)


def test_spans_are_maximal(docs):
    once = " ".join(f"w{i}" for i in range(30))
    row = found(docs([(1, once), (2, f"x {once} y {once}")]))[2]
    assert row["spans"] == [[1, 31], [32, 62]] and bytes(row["kept"]) == b"x y"


def test_nulls_empty_repeated_and_long(docs):
    text, long = " ".join("abcdefghijklmnopqrstuvwxyz"), " ".join(str(i) for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (None, text), (6, "a b"), (7, long), (8, long + " end")]
    got = found(docs(rows))
    assert [got[i]["n_words"] for i in (1, 2, 3, 4, 6, 7)] == [0, 0, 0, 26, 2, 200_000]
    assert all(got[i]["n_removed"] == 0 for i in (1, 2, 3, 4, None, 6, 7))
    assert bytes(got[8]["kept"]) == b"end"
    twice = substring_dedup.remove_repeats(docs([(4, text), (4, text), (5, text)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in twice) == [(4, 0), (4, 0), (5, 26)]


def test_extreme_ids_empty_table_and_clashing_columns(docs, clashing):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    got = found(clashing([(2**63 - 1, text), (-(2**63), text), (0, text)]))
    assert {i: r["n_removed"] for i, r in got.items()} == {-(2**63): 0, 0: 26, 2**63 - 1: 26}
    assert substring_dedup.remove_repeats(docs([])).count() == 0


def test_settled_windows_spread_over_the_buckets():
    """Twenty tasks of three blocks each: no bucket gets much more of what blocks have settled than others."""
    counts = np.zeros(64, int)
    for task in range(20):
        for block in range(3):
            places = substring_dedup.settled_places(task, block, 64)
            assert len(set(places.tolist())) == substring_dedup.PIECES
            counts[places] += 1
    assert counts.max() <= 4 * counts.mean() and (counts > 0).mean() > 0.9
    assert substring_dedup.settled_places(7, 3, 1).tolist() == [0]
