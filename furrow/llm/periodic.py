"""Runs of words: maximal stretches that repeat themselves with some period, and texts without the repeats.

Periods up to ``SHORT`` are found by comparing the words with themselves at every such lag. Longer periods fall into
scales. A scale of the periods ``low`` to ``high`` takes, of every window of Rabin-Karp hashes of ``high`` words, the
leftmost least hash. A window and the same window one period on both lie inside a run of three periods, so they name
places one period apart; and no place between them has the same hash, for a run whose hashed words are no fewer than
its period holds equal ones only at multiples of it. So consecutive places of equal hash, ``low`` to ``high`` apart,
seed every run. A seed is extended word by word to both sides, which decides.

Documents are cut into words and numbered a portion at a time, longest first, and a scale looks at the documents that
are long enough for it. Rows are neither joined nor moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from furrow.llm.tables import documents, mixed, slices

SHORT = 16  # longest period that is looked for by its lag
PORTION = 1_000_000  # bytes of text in a portion
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
RESULT_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


@dataclass(frozen=True)
class Least:
    """A run has at least ``words`` words and ``periods`` times its period; fewer than three periods seed no run."""

    words: int = 24
    periods: int = 3

    def __post_init__(self) -> None:
        if self.periods < 3:
            raise ValueError("runs of fewer than three periods are not found by this method")

    def length(self, period: int) -> int:
        return max(self.words, self.periods * period)


def collapse(docs: DataFrame, least: Least = Least(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row of ``docs``.

    Words stand between ASCII blanks and are numbered from 0. A run is a stretch whose words equal those ``period``
    further on, for its smallest such period, that no neighbouring word extends; ``runs`` are sorted by start, then
    period. ``collapsed`` holds the words that no run contains after its first period, joined by one space. Null and
    empty texts have no words, no run and an empty ``collapsed``. Repeated rows give repeated results, an empty table an
    empty one; other columns take no part, and a null id stays null. A text of any length is read whole, with some 100
    bytes of memory a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).view(pa.string()).fill_null("")
            done = 0
            for part in slices(texts, PORTION):
                yield _collapsed(batch.column(0).slice(done, len(part)), part, least)
                done += len(part)

    return documents(docs, id_col, text_col).mapInArrow(run, RESULT_SCHEMA)


def _collapsed(ids: pa.Array, texts: pa.Array, least: Least) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
    ends = np.concatenate([[0], np.cumsum(real)])[cuts]  # of the documents, in words
    words = flat.filter(pa.array(real))
    numbers = words.dictionary_encode().indices.to_numpy()
    found = find_runs(numbers, ends, least)

    kept = np.ones(len(words), bool)
    for doc, start, length, period in found:
        first = ends[doc] + start
        kept[first + period : first + length] = False
    left = np.concatenate([[0], np.cumsum(kept)])[ends]
    lists = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(kept)))
    per_doc = np.searchsorted([doc for doc, *_ in found], np.arange(len(texts) + 1)).astype(np.int32)
    columns = [pa.array([r[i] for r in found], pa.int64()) for i in (1, 2, 3)]
    runs = pa.ListArray.from_arrays(pa.array(per_doc), pa.StructArray.from_arrays(columns, fields=list(RUN)))
    joined = pc.binary_join(lists, " ").cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(ends), pa.int64()), runs, joined], schema=RESULT)


def find_runs(numbers: np.ndarray, ends: np.ndarray, least: Least = Least()) -> list[tuple[int, int, int, int]]:
    """``(document, start, length, period)`` of all runs, sorted.

    ``numbers`` are the words of the documents one after another, equal numbers for equal words, and ``ends`` the places
    where the documents begin, and the end.
    """
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= least.length(1)]
    if not len(order):
        return []
    # The documents behind one another, longest first. Between them stands a number that occurs once: a stretch of
    # equal words that reached past it would be shorter than its lag.
    sizes, gaps = sizes[order], -np.arange(1, len(order) + 2)
    line = np.empty(sizes.sum() + len(order) + 1, np.int64)
    firsts = np.cumsum(np.concatenate([[1], sizes[:-1] + 1]))
    line[0], line[firsts + sizes] = gaps[0], gaps[1:]
    for first, doc, size in zip(firsts.tolist(), order.tolist(), sizes.tolist()):
        line[first : first + size] = numbers[ends[doc] : ends[doc + 1]]

    def upto(period: int) -> int:
        """The end of the documents that may hold a run of the period."""
        n = int(np.searchsorted(-sizes, -least.length(period), "right"))
        return int(firsts[n - 1] + sizes[n - 1] + 1) if n else 0

    found = {(a, b - a, q) for q in range(1, SHORT + 1) for a, b in _at_lag(line[: upto(q)], q, least) if _smallest(line, a, q)}
    found.update(_by_scales(line, upto, least))
    docs = np.searchsorted(firsts, [a for a, _, _ in found], "right") - 1
    return sorted((int(order[d]), a - int(firsts[d]), n, q) for d, (a, n, q) in zip(docs.tolist(), found))


def _at_lag(line: np.ndarray, period: int, least: Least) -> Iterator[tuple[int, int]]:
    """Stretches ``[start, end)`` of the period, found by comparing all words with those a period on."""
    same = np.flatnonzero(line[:-period] == line[period:])
    if not len(same):
        return
    cuts = np.flatnonzero(np.diff(same) > 1)
    starts, lasts = same[np.append(0, cuts + 1)], same[np.append(cuts, len(same) - 1)]
    long = lasts - starts + 1 + period >= least.length(period)
    yield from zip(starts[long].tolist(), (lasts[long] + 1 + period).tolist())


def _smallest(line: np.ndarray, start: int, period: int) -> bool:
    """No smaller period: one would divide this period, as there are at least two of it."""
    block = line[start : start + period]
    for parts in range(2, period + 1):
        if period % parts == 0 and np.array_equal(block[: period - period // parts], block[period // parts :]):
            return False
    return True


def _by_scales(line: np.ndarray, upto, least: Least) -> Iterator[tuple[int, int, int]]:
    values = mixed(line.astype(np.uint64) + np.uint64(BASE))
    steps = np.full(len(line), BASE, np.uint64)
    steps[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(steps))])
    steps[1:] = INVERSE
    back = np.cumprod(steps)
    place = np.arange(len(line), dtype=np.uint64)
    low_bits = np.uint64((1 << len(line).bit_length()) - 1)
    low = SHORT + 1
    while end := upto(low):
        high = low * 4 // 3
        width = 2 * low - high + 1  # as wide as a window may be for two of them to lie in three periods
        n = end - high + 1  # windows of words; all are long enough, for a document has at least 3 * low words
        hashes = (sums[high : high + n] - sums[:n]) * back[:n]
        least_here = _window_least((hashes & ~low_bits) | place[:n], width) & low_bits
        at = least_here[np.append(True, least_here[1:] != least_here[:-1])].astype(np.int64)
        by_hash = np.argsort(hashes[at], kind="stable")
        at = at[by_hash]
        apart = np.diff(at)
        seeds = np.flatnonzero((apart >= low) & (apart <= high) & (hashes[at[1:]] == hashes[at[:-1]]))
        yield from _extended(line, sorted(zip(apart[seeds].tolist(), at[seeds].tolist())), least)
        low = high + 1


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from spans of doubling width."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _extended(line: np.ndarray, seeds: list[tuple[int, int]], least: Least) -> Iterator[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs at ``(period, place)`` seeds, which are sorted."""
    before, done = 0, 0
    for period, place in seeds:
        if period == before and place < done:
            continue  # inside the stretch of the seed before
        start, end = _stretch(line, place, period)
        before, done = period, end - period
        if end - start >= least.length(period) and _smallest(line, start, period):
            yield start, end - start, period


def _stretch(line: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The longest ``[start, end)`` around ``place`` in which words equal those a period on.

    The line begins and ends with numbers that occur once, so that no stretch reaches its ends.
    """
    left, step = place, 64
    while True:
        a = max(0, left - step)
        differ = np.flatnonzero(line[a:left] != line[a + period : left + period])
        if len(differ):
            left = a + int(differ[-1]) + 1
            break
        left, step = a, 2 * step
    right, step = place, 64
    while True:
        b = min(len(line) - period, right + step)
        differ = np.flatnonzero(line[right:b] != line[right + period : b + period])
        if len(differ):
            return left, right + int(differ[0]) + period
        right, step = b, 2 * step
