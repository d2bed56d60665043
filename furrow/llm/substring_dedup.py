"""Removal of word sequences that occur earlier in the corpus.

Every window of a fixed number of words has a Rabin-Karp hash. Tasks gather the hashes of a block of documents, settle
what repeats inside the block, and send each remaining hash once to the bucket that a second Rabin-Karp hash names.
A bucket counts its hashes and answers, per part of the documents, with those whose first owner is another document.
Parts then meet their documents, which merge their repeated windows into maximal intervals and drop the words these
cover.

A pair of windows is taken for equal when both hashes agree: 64 bits, and the bucket's number, which has more bits the
more data there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.llm.tables import (
    buckets_for,
    documents,
    freed,
    mixed,
    prime_from,
    released,
    total_words,
    values,
    window_hashes,
    word_hashes,
)

WIDTH = 20
BASE, BUCKET_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
BLOCK = 1_000_000  # windows that a task settles at once
BUCKET = 2_000_000  # windows per bucket
PIECES = 4  # in which a block's settled windows are passed on
PART = 1_500_000  # words of the documents that a task finishes at once

SENT, SETTLED = 0, 1
REQUEST = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int8()), ("ids", pa.binary()), ("owners", pa.binary()), ("hashes", pa.binary())]
)
REQUEST_SCHEMA = "bucket int, kind byte, ids binary, owners binary, hashes binary"
ANSWER = pa.schema([("part", pa.int64()), ("ids", pa.binary()), ("hashes", pa.binary())])
ANSWER_SCHEMA = "part long, ids binary, hashes binary"
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("kept", pa.binary()),
    ]
)
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept binary"


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None
) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)`` of every row of ``docs``.

    Words stand between ASCII blanks. A word goes if some window of ``width`` words over it also starts earlier: in a
    document with a smaller id, or further ahead in the same one. Windows are judged on the input. ``spans`` are the
    removed intervals ``[start, end)`` of words, ``kept`` the other words joined by one space, as UTF-8. Rows that
    share an id do not shadow each other; from rows without an id nothing goes, and they shadow nothing. Null text has
    no words. An empty table gives an empty result; other columns take no part, but a column ``keep`` comes back as
    ``row``, next to ``text``: what is left of the text, as it was if nothing is removed.
    """
    texts = documents(docs, id_col, text_col, **({} if keep is None else {"row": keep}))
    words = total_words(texts)
    buckets, parts = buckets_for(words, BUCKET), prime_from(buckets_for(words, PART))
    known = texts.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    requests = known.mapInArrow(lambda batches: _requests(batches, width, buckets), REQUEST_SCHEMA)
    answers = requests.groupBy("bucket").applyInArrow(lambda table: _answers(table, parts), ANSWER_SCHEMA)
    part = F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(parts)).alias("part")
    schema = T._parse_datatype_string(RESULT_SCHEMA)
    if keep is not None:
        schema = T.StructType([*schema.fields, *texts.schema.fields[1:]])
    return (
        texts.select(part, *texts.columns)
        .groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(lambda docs, answers: _removals(docs, answers, width), schema)
    )


@released
def _requests(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    words, task = word_hashes(), TaskContext.get().partitionId()
    ids, hashes, places, held, block = [], [], [], 0, 0
    for batch in batches:
        for name, text in zip(values(batch.column(0)), values(batch.column(1))):
            own = words.of((text or b"").split())
            if len(own) < width:
                continue
            ids.append(name)
            hashes.append(mixed(window_hashes(own, width, BASE)))
            places.append(_bucket(window_hashes(own, width, BUCKET_BASE), buckets))
            held += len(hashes[-1])
            if held >= BLOCK:
                yield from _settled(ids, hashes, places, buckets, task, block)
                ids, hashes, places, held, block = [], [], [], 0, block + 1
    if ids:
        yield from _settled(ids, hashes, places, buckets, task, block)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    # The high half of the mixed hash, scaled to the number of buckets.
    return ((mixed(hashes) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def settled_places(task: int, block: int, buckets: int) -> np.ndarray:
    """The buckets that pass on what a block has settled, which needs no bucket of its own: some neighbours, as even
    over tasks and blocks as a hash makes them."""
    start = int(mixed(np.array([task << 32 | block], np.uint64))[0] % np.uint64(buckets))
    return (start + np.arange(min(PIECES, buckets))) % buckets


def _settled(ids, hashes, places, buckets, task, block) -> Iterator[pa.RecordBatch]:
    """The requests of one block: a hash goes out once, for its first document; the block's others are settled."""
    names, owner_of = np.unique(np.array(ids, np.int64), return_inverse=True)
    order = np.argsort(owner_of, kind="stable").tolist()
    owner = np.repeat(owner_of[order], [len(hashes[i]) for i in order]).astype(np.uint32)
    place = np.concatenate([places[i] for i in order])
    value = np.concatenate([hashes[i] for i in order])
    by_value = np.argsort(value, kind="stable")
    value, owner, place = value[by_value], owner[by_value], place[by_value]
    first = np.append(True, (value[1:] != value[:-1]) | (place[1:] != place[:-1]))
    lead = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    again = owner != lead
    if again.any():
        places = settled_places(task, block, buckets)
        pieces = (np.array_split(x[again], len(places)) for x in (owner, value))
        yield _request(places, SETTLED, names, *pieces)
    value, owner, place = value[first], owner[first], place[first]
    by_place = np.lexsort((owner, place))
    value, owner, place = value[by_place], owner[by_place], place[by_place]
    cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
    yield _request(place[np.append(0, cuts)], SENT, names, np.split(owner, cuts), np.split(value, cuts))


def _request(places, kind, names, owners, hashes) -> pa.RecordBatch:
    rows = []
    for own in owners:  # only the documents that this bucket hears of
        present, index = np.unique(own, return_inverse=True)
        rows.append((names[present].tobytes(), index.astype(np.uint32).tobytes()))
    columns = [
        pa.array(places, pa.int32()),
        pa.array([kind] * len(rows), pa.int8()),
        pa.array([r[0] for r in rows], pa.binary()),
        pa.array([r[1] for r in rows], pa.binary()),
        pa.array([h.tobytes() for h in hashes], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=REQUEST)


@freed
def _answers(table: pa.Table, parts: int) -> pa.Table:
    """Of one bucket, the hashes that each document shares with an earlier one."""
    kind = table.column("kind").to_numpy()
    owners, hashes = [], []
    for ids, index, value in zip(*(values(table.column(c)) for c in ("ids", "owners", "hashes"))):
        owners.append(np.frombuffer(ids, np.int64)[np.frombuffer(index, np.uint32)])
        hashes.append(np.frombuffer(value, np.uint64))
    settled_ids = [o for o, k in zip(owners, kind) if k == SETTLED]
    settled = [h for h, k in zip(hashes, kind) if k == SETTLED]
    owners = [o for o, k in zip(owners, kind) if k == SENT]
    hashes = [h for h, k in zip(hashes, kind) if k == SENT]
    if hashes:
        owner, value = np.concatenate(owners), np.concatenate(hashes)
        order = np.argsort(value)
        value = value[order]
        same = value[1:] == value[:-1]
        shared = np.append(same, False) | np.append(False, same)
        owner, value = owner[order[shared]], value[shared]
        if len(value):
            starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            lead = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(value))))
            settled_ids.append(owner[owner != lead])
            settled.append(value[owner != lead])
    if not settled:
        return ANSWER.empty_table()
    owner, value = np.concatenate(settled_ids), np.concatenate(settled)
    part = np.mod(owner, parts)
    order = np.argsort(part, kind="stable")
    part, owner, value = part[order], owner[order], value[order]
    starts = np.append(0, np.flatnonzero(part[1:] != part[:-1]) + 1)[: len(part)]
    cuts = starts[1:]
    blobs = [[a.tobytes() for a in np.split(array, cuts)][: len(starts)] for array in (owner, value)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip([part[starts], *blobs], ANSWER)], schema=ANSWER)


def intervals(starts: np.ndarray, width: int) -> np.ndarray:
    """Maximal intervals ``[start, end)`` covered by windows of ``width`` at the sorted ``starts``."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(starts) > width)
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + width], 1)


@freed
def _removals(docs: pa.Table, answers: pa.Table, width: int) -> pa.Table:
    """The documents of one part without the words that its answers and their own repeats cover."""
    owner = np.frombuffer(b"".join(values(answers.column("ids"))), np.int64)
    order = np.argsort(owner, kind="stable")
    owner, shared = owner[order], np.frombuffer(b"".join(values(answers.column("hashes"))), np.uint64)[order]
    words, rows = word_hashes(), []
    for name, text in zip(values(docs.column("doc_id")), values(docs.column("text"))):
        own = (text or b"").split()
        spans = np.empty((0, 2), np.int64)
        if name is not None and len(own) >= width:
            value = mixed(window_hashes(words.of(own), width, BASE))
            order = np.argsort(value, kind="stable")
            repeated = np.zeros(len(value), bool)
            repeated[order[1:]] = value[order[1:]] == value[order[:-1]]
            first, last = np.searchsorted(owner, name, "left"), np.searchsorted(owner, name, "right")
            if last > first:
                repeated |= np.isin(value, shared[first:last])
            spans = intervals(np.flatnonzero(repeated), width)
        kept = own
        if len(spans):
            bounds = [0, *spans.ravel().tolist(), len(own)]
            kept = [w for a, b in zip(bounds[::2], bounds[1::2]) for w in own[a:b]]
        rows.append((name, len(own), len(own) - len(kept), spans.tolist(), b" ".join(kept)))
    columns = zip(*rows) if rows else [[] for _ in RESULT]
    result = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)
    if "row" in docs.column_names:
        left = [kept if n else text for text, (_, _, n, _, kept) in zip(values(docs.column("text")), rows)]
        result = result.append_column("text", pa.array(left, pa.binary())).append_column("row", docs.column("row"))
    return result
