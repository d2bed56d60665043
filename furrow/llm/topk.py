"""Exact search for the highest inner products by an impact-ordered index, a band of scores at a time.

Components are integers. A block of vectors is stored as posting segments by impact: the components whose magnitude lies
between two levels, as postings (vector, value) by dimension; zeros have none. Segments are processed in the order of
falling impact and add to the scores of a block of queries. After each, what the segments to come can still add is
bounded: a vector that can be among no query's best is dropped on that proof, and its later postings are skipped. Once
few enough vectors can be among a query's best, the possible members are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.tables import values
from furrow.schemas import require_columns
from furrow.workspace import materialize

SCALE = 256
VECTORS = 4_096  # per block of the index
QUERIES = 64  # per block of queries: few enough that a vector may be out of question for all of them
CELL_BLOCKS, CELL_QUERIES = 4, 64  # blocks of the index and of queries that meet in a task
LEVELS = 6  # segments of a block: halving impacts, then the rest
POSSIBLE = 64  # possible members of a query that are scored one by one
QUERY = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("matrix", pa.binary()), ("width", pa.int32())])
QUERY_SCHEMA = "block long, ids binary, matrix binary, width int"
# Of every segment: where its dimensions begin, its postings, and what each vector has left after it.
PARTS = ["offsets", "places", "values", "rests"]
BLOCK = pa.schema([*QUERY, *[(part, pa.list_(pa.binary())) for part in PARTS]])
BLOCK_SCHEMA = QUERY_SCHEMA + "".join(f", {part} array<binary>" for part in PARTS)
KINDS = {"offsets": np.int32, "places": np.int32, "values": np.int64, "rests": np.float64}
HIT_SCHEMA = "query_id long, vec_id long, score long"
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<long>)``: every component as ``floor(256 * x)``.

    Rows without id and vectors that are null, empty, or hold null or non-finite components take no part.
    """
    require_columns(vectors, [id_col, vector_col])
    x = F.transform(vectors[vector_col], lambda v: v.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & finite)
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("x"))


@dataclass
class Segment:
    """Postings of one band of impacts: those of dimension ``d`` lie from ``offsets[d]`` to ``offsets[d + 1]``.

    ``rests`` are the lengths of the vectors without this and earlier segments.
    """

    offsets: np.ndarray
    places: np.ndarray
    values: np.ndarray
    rests: np.ndarray


def segments(matrix: np.ndarray) -> list[Segment]:
    """The posting segments of a block of vectors, highest impacts first."""
    impact, above, out = np.abs(matrix), np.inf, []
    for level in [*(impact.max(initial=0) / 2.0 ** np.arange(1, LEVELS)), 0.0]:
        dimension, place = np.nonzero(((impact > level) & (impact <= above)).T)
        offsets = np.searchsorted(dimension, np.arange(matrix.shape[1] + 1))
        rests = np.linalg.norm(np.where(impact <= level, matrix, 0).astype(float), axis=1)
        out.append(Segment(offsets, place, matrix[place, dimension], rests))
        above = level
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int, indexed: bool) -> Iterator[pa.RecordBatch]:
    """Rows of equal width in blocks: ids, a matrix of 64-bit integers, and the segments of ``indexed`` ones."""
    number = TaskContext.get().partitionId() << 32
    held: dict[int, list[tuple[int, list[int]]]] = {}
    schema = BLOCK if indexed else QUERY

    def block(rows: list[tuple[int, list[int]]], number: int) -> pa.RecordBatch:
        ids, matrix = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        columns = [[number], [ids.tobytes()], [matrix.tobytes()], [matrix.shape[1]]]
        if indexed:
            found = segments(matrix)
            columns += [[[getattr(s, part).astype(KINDS[part]).tobytes() for s in found]] for part in PARTS]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for name, x in zip(*map(values, batch.columns)):
            rows = held.setdefault(len(x), [])
            rows.append((name, x))
            if len(rows) >= size:
                yield block(held.pop(len(x)), number)
                number += 1
    for rows in held.values():
        yield block(rows, number)
        number += 1


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner products of each query, ties to smaller ids.

    Both tables are as :func:`quantised` gives them. A row with the query's id is no candidate for it; vectors of another
    width are none either. Of query rows that share an id the smallest vector counts; candidates that repeat are ranked
    each. A query with fewer than ``k`` candidates has all of them; empty tables give an empty result.

    Queries and vectors meet in the cells of a grid, a few blocks of each to a cell.
    """
    queries = queries.groupBy("vec_id").agg(F.min("x").alias("x"))
    index = vectors.select("vec_id", "x").mapInArrow(lambda b: _blocks(b, VECTORS, True), BLOCK_SCHEMA)
    asked = queries.mapInArrow(lambda b: _blocks(b, QUERIES, False), QUERY_SCHEMA)
    index, asked = materialize(index, "index"), materialize(asked, "queries")
    rows, columns = (-(-table.count() // per) or 1 for table, per in ((index, CELL_BLOCKS), (asked, CELL_QUERIES)))

    def placed(table: DataFrame, own: str, of: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64("block", "ids"), F.lit(of)).alias(own)
        every = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
        return table.select("*", place, F.explode(every).alias(other))

    left = placed(index, "row", rows, "column", columns).groupBy("row", "column")
    right = placed(asked, "column", columns, "row", rows).groupBy("row", "column")
    hits = left.cogroup(right).applyInArrow(lambda index, asked: _cell(index, asked, k), HIT_SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _unpacked(table: pa.Table) -> Iterator[tuple]:
    """Ids, matrix and, of blocks of the index, segments."""
    ids, matrices, widths = (values(table.column(c)) for c in QUERY.names[1:])
    stored = zip(*(values(table.column(part)) for part in PARTS)) if PARTS[0] in table.column_names else repeat(None)
    for own, matrix, width, parts in zip(ids, matrices, widths, stored):
        found = [Segment(*(np.frombuffer(b, KINDS[part]) for part, b in zip(PARTS, s))) for s in zip(*parts)] if parts else []
        yield np.frombuffer(own, np.int64), np.frombuffer(matrix, np.int64).reshape(-1, width), found


def _cell(index: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    found: list[tuple[int, int, int]] = []
    asked_blocks = [(ids, matrix) for ids, matrix, _ in _unpacked(asked)]
    for ids, matrix, postings in _unpacked(index):
        for query_ids, queries in asked_blocks:
            if queries.shape[1] == matrix.shape[1]:
                found.extend(search_block(ids, matrix, postings, query_ids, queries, k)[0])
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[], [], []])], schema=HITS)


def search_block(
    ids: np.ndarray, matrix: np.ndarray, postings: list[Segment], query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[list[tuple[int, int, int]], int]:
    """``(query id, id, score)`` of the ``k`` best of one block of vectors for each of a block of queries.

    Beside them, the number of postings that were processed.
    """
    weight, touched = np.linalg.norm(queries.astype(float), axis=1), 0
    by_dimension = queries.astype(float).T.copy()
    scores = np.zeros((len(ids), len(queries)))  # of the vectors that still are in question
    own = ids[:, None] == query_ids[None, :]
    # Doubles add such integers without error; beyond, sums may be off by as much as this.
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(matrix).max(initial=0)) * matrix.shape[1]
    slack = 0.0 if size < 2**53 else size * 1e-12
    active, possible = np.arange(len(ids)), ~own
    row = np.arange(len(ids))  # of a vector among the active ones, or -1
    for segment in postings:
        for dimension in np.flatnonzero(np.diff(segment.offsets)).tolist():
            part = slice(segment.offsets[dimension], segment.offsets[dimension + 1])
            at = row[segment.places[part]]
            value, at = segment.values[part][at >= 0], at[at >= 0]  # postings of dropped vectors are skipped
            touched += len(at)
            scores[at] += value[:, None] * by_dimension[dimension]
        # Cauchy and Schwarz: the segments to come add no more.
        still = segment.rests[active][:, None] * weight * (1 + 1e-9) + slack
        least = np.where(own[active], -np.inf, scores - still)
        bar = np.partition(least, -k, axis=0)[-k] if len(active) > k else np.full(len(queries), -np.inf)
        possible = (scores + still >= bar) & ~own[active]
        stay = possible.any(1)
        active, scores, possible = active[stay], scores[stay], possible[stay]
        row = np.full(len(ids), -1)
        row[active] = np.arange(len(active))
        if possible.sum() <= POSSIBLE * len(queries):
            break
    exact, out = np.int64 if size < 2**62 else object, []
    for q, query_id in enumerate(query_ids.tolist()):
        at = active[possible[:, q]]
        score = matrix[at].astype(exact) @ queries[q].astype(exact)
        for i in sorted(range(len(at)), key=lambda i: (-score[i], ids[at[i]]))[:k]:
            out.append((query_id, int(ids[at[i]]), int(score[i])))
    return out, touched
