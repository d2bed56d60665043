from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import topk


def plain(vectors, k):
    kept = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in vectors
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in kept if i % 5 == 0}):
        query = min(v for i, v in kept if i == q)
        scored = [(-sum(a * b for a, b in zip(query, v)), i) for i, v in kept if i != q and len(v) == len(query)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def search(spark, vectors, k=5):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<float>, block string, x int")
    rows = topk.quantised(table)
    return sorted(map(tuple, topk.top_k(rows, rows.where(F.col("vec_id") % 5 == 0), k).collect()))


def single(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("spread", [0.2, 0.01])
def test_against_plain_python(spark, monkeypatch, spread):
    """Coarse vectors, with many ties, over several blocks and cells."""
    for name, value in (("VECTORS", 32), ("QUERIES", 7), ("CELL_BLOCKS", 2), ("CELL_QUERIES", 2), ("POSSIBLE", 3)):
        monkeypatch.setattr(topk, name, value)
    random.seed(3)
    vectors = single((i, [random.gauss(0, spread) for _ in range(8)]) for i in random.sample(range(1000), 200))
    assert search(spark, vectors) == plain(vectors, 5)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = single(
        [(0, [0.5, -0.5]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]),
         (6, [0.1, 0.2, 0.3]), (7, [0.5, 0.5]), (10, [0.25, 0.5]), (8, [0.5, 0.5])]
    )
    assert search(spark, vectors) == plain(vectors, 5)
    assert search(spark, vectors, 1) == plain(vectors, 1)


def test_repeated_rows_and_empty_tables(spark):
    vectors = single([(5, [0.5]), (5, [0.25]), (1, [0.5]), (1, [0.5]), (2, [0.125])])
    assert search(spark, vectors) == [(5, 1, 1, 64 * 128), (5, 2, 1, 64 * 128), (5, 3, 2, 64 * 32)]
    assert search(spark, [(1, [0.5])]) == [] and search(spark, []) == []


def test_large_numbers_are_exact():
    ids, matrix = np.arange(4), np.array([[2**31, 2**31 - 1], [2**31, 2**31], [1, 0], [-(2**31), 5]])
    query = np.array([[2**31, 2**31 - 1]])
    got, _ = topk.search_block(ids, matrix, topk.segments(matrix), np.array([9]), query, 2)
    assert got == [(9, 1, 2**62 + (2**31 - 1) * 2**31), (9, 0, 2**62 + (2**31 - 1) ** 2)]


def test_it_stops_on_proof():
    """Vectors apart from the rest are found from the first segments; the scores are exact all the same."""
    random.seed(1)
    matrix = np.array([[random.randint(-9, 9) for _ in range(16)] for _ in range(500)])
    matrix[::100] += 200
    queries, postings = matrix[::100].copy(), topk.segments(matrix)
    got, touched = topk.search_block(np.arange(500), matrix, postings, np.arange(5) + 1000, queries, 3)
    assert touched < (matrix != 0).sum() / 20
    for q in range(5):
        scores = matrix @ queries[q]
        want = sorted(range(500), key=lambda i: (-scores[i], i))[:3]
        assert [(i, s) for query, i, s in got if query == 1000 + q] == [(i, scores[i]) for i in want]


def test_segments_hold_every_component_once_by_impact():
    matrix = np.random.default_rng(6).integers(-100, 100, (50, 7))
    found, whole, least = topk.segments(matrix), np.zeros_like(matrix), np.inf
    for s in found:
        for d in range(7):
            part = slice(s.offsets[d], s.offsets[d + 1])
            whole[s.places[part], d] += s.values[part]
        if len(s.values):
            assert np.abs(s.values).max() < least
            least = np.abs(s.values).min()
        assert np.allclose(s.rests, np.linalg.norm(matrix - whole, axis=1))
    assert (whole == matrix).all() and sum(len(s.values) for s in found) == (matrix != 0).sum()


def test_postings_of_the_given_table_are_skipped(spark):
    """On real vectors a part of the postings is never looked at, and what is stored is what is processed."""
    table = topk.quantised(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    vectors = [tuple(r) for r in table.collect()]
    ids, matrix = np.array([i for i, _ in vectors]), np.array([x for _, x in vectors])
    asked = np.flatnonzero(ids % 50 == 0)
    postings, touched, held = topk.segments(matrix), 0, 0
    for at in range(0, len(asked), topk.QUERIES):
        part = asked[at : at + topk.QUERIES]
        touched += topk.search_block(ids, matrix, postings, ids[part], matrix[part], 5)[1]
        held += int((matrix != 0).sum())
    assert 0 < touched < 0.95 * held
