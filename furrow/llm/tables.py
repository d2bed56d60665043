"""What the text operators share: their view of a table of documents, and words."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.schemas import require_columns

# Bytes between which words stand: space, tab, line feed, vertical tab, form feed, carriage return.
# ``bytes.split()`` parts at exactly these.
BLANKS = r"[\x20\x09-\x0D]+"

AVERAGE_WORD_BYTES = 6


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """``(doc_id long, text binary)`` of any table of documents, and ``more``; its other columns take no part."""
    require_columns(docs, [id_col, text_col])
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[text_col].cast("string").cast("binary").alias("text"),
        *[column.alias(name) for name, column in more.items()],
    )


def total_words(texts: DataFrame) -> int:
    """About the number of words in a table of :func:`documents`, from one count of bytes."""
    octets = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    return (octets or 0) // AVERAGE_WORD_BYTES


def buckets_for(words: int, per_bucket: int) -> int:
    """Number of buckets that keep a bucket near ``per_bucket`` entries at every size of the input."""
    return max(1, math.ceil(words / per_bucket))


def prime_from(n: int) -> int:
    """The first prime from ``n`` on: a number of parts that no step between ids has as a divisor."""
    while n < 2 or any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


class WordHashes(dict):
    """64-bit hash per word, remembered until ``limit`` words are held."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """The process's word hashes, so that batches and groups share them."""
    return WordHashes()


MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit hashes over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(29))
    x = x * MIX_2
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` words: the polynomial ``sum h[i + k] * base ** (width - 1 - k)``.

    Runs of doubling length are put together from two halves, so a window takes ``log2(width)`` steps.
    """
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    done, out, part, length = 0, None, words, 1
    while True:
        if width & length:
            if out is None:
                out = part
            else:
                power = np.uint64(pow(base, length, 1 << 64))
                m = len(part) - done
                out = out[:m] * power + part[done : done + m]
            done += length
        if length * 2 > width:
            return out[:n]
        power = np.uint64(pow(base, length, 1 << 64))
        part = part[:-length] * power + part[length:]
        length *= 2


class Remembered(dict):
    """Results by key for the keys of late, in two generations of about ``limit`` keys."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def turn(self) -> None:
        """Begin a new generation if the young one is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def unknown(self, keys: Iterable) -> list:
        """Bring distinct ``keys`` into the young generation; those not remembered are returned, for the caller to add."""
        self.turn()
        fresh = []
        for key in [key for key in keys if key not in self]:
            found = self.old.get(key)
            if found is None:
                fresh.append(key)
            else:
                self[key] = found
        return fresh


def portions(texts: Iterable[bytes | None], octets: int = 2_000_000) -> Iterator[list[bytes]]:
    """Texts in runs of about ``octets`` bytes, null as empty."""
    run, size = [], 0
    for text in texts:
        run.append(text or b"")
        size += len(run[-1])
        if size > octets:
            yield run
            run, size = [], 0
    if run:
        yield run


def values(column: pa.Array) -> Iterator:
    """The values of an Arrow column one at a time, so that they need not all be Python objects at once."""
    return (value.as_py() for value in column)


def slices(texts: pa.Array, octets: int) -> Iterator[pa.Array]:
    """An array of texts in runs of about ``octets`` bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // octets
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
    return (texts[a:b] for a, b in zip(cuts, cuts[1:]) if b > a)


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's call that gives free memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory that is free back to the system: a worker that is reused would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a task over batches, with :func:`release` at its end, and before it, for what tasks of groups have left."""

    @wraps(run)
    def task(batches: Iterator, *more) -> Iterator:
        word_hashes.cache_clear()
        release()
        try:
            yield from run(batches, *more)
        finally:
            word_hashes.cache_clear()
            release()

    return task


def freed(run: Callable) -> Callable:
    """``run``, a task over a group, that leaves no free memory behind: its worker may idle through the next stage."""

    @wraps(run)
    def task(*tables):
        try:
            return run(*tables)
        finally:
            release()

    return task
