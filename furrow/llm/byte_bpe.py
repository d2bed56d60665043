"""Byte-level byte-pair encoding and decoding by the ranks of a published vocabulary.

A segment tree over the byte positions of a piece holds the rank of every pair of neighbours; its root is the leftmost
pair of least rank. A merge joins the pair at the root and makes three point updates: at the joined token, at the
live neighbour before it and at the position that died. Pieces of the same size class run in step, one tree per row
of a matrix; long pieces run alone.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from furrow.llm.tables import documents

IN_STEP = 64  # longest piece, in bytes, that runs in step with others
NONE = np.int64(1) << 60
REMEMBERED = 250_000  # pieces per generation of the cache
TEXT_AT_ONCE = 2_000_000  # characters


class Encoder:
    """Encodes and decodes with the rank file at ``path``; ``pattern`` cuts a text into pieces."""

    def __init__(self, path: str, pattern: str):
        self.find = regex.compile(pattern).findall
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {str(rank): token for token, rank in self.ranks.items()}
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, NONE)
        self.pair_ranks = np.append(np.array([pairs[k] for k in keys.tolist()], np.int64), 0)
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    # Texts

    def encode(self, texts: list[str]) -> list[str]:
        """Token ids of each text as decimals joined by one space."""
        pieces = [self.find(text) for text in texts]
        self._learn(set(chain.from_iterable(pieces)))
        known = self.young.__getitem__
        return [" ".join(map(known, found)) for found in pieces]

    def decode(self, ids: str) -> bytes:
        """The bytes of token ids given as by :meth:`encode`."""
        return b"".join(map(self.tokens.__getitem__, ids.split(" "))) if ids else b""

    def _learn(self, pieces: set[str]) -> None:
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        fresh = []
        for piece in pieces - self.young.keys():
            ids = self.old.get(piece)
            if ids is None:
                fresh.append(piece)
            else:
                self.young[piece] = ids
        self.young.update(zip(fresh, self.encode_pieces([piece.encode("utf-8") for piece in fresh])))

    # Pieces

    def encode_pieces(self, pieces: list[bytes]) -> list[str]:
        """Ids of each piece. A piece that is a token itself is that token."""
        out: list[str] = [""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = str(rank)
            elif len(piece) > IN_STEP:
                out[i] = " ".join(map(str, self.encode_long(piece)))
            else:
                classes.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for size, members in classes.items():
            for i, ids in zip(members, self._in_step([pieces[i] for i in members], size)):
                out[i] = ids
        return out

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.pair_ranks[at], NONE)

    def _in_step(self, pieces: list[bytes], size: int) -> Iterator[str]:
        n, bits = len(pieces), size.bit_length() - 1
        end = size  # position after the last byte, and before the first
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        token = np.zeros((n, size + 1), np.int64)
        token[:, :size] = self.byte_rank[raw]
        place = np.arange(size + 1)
        following = np.where(place[None, :] + 1 < lengths[:, None], place + 1, end)
        previous = np.where(place == 0, end, place - 1)[None, :].repeat(n, 0)
        live = place[None, :size] < lengths[:, None]
        tree = np.full((n, 2 * size), NONE)
        pair = place[None, : size - 1] + 1 < lengths[:, None]
        ranks = self._rank_of(token[:, : size - 1], token[:, 1:size])
        tree[:, size : 2 * size - 1] = np.where(pair & (ranks < NONE), ranks << bits | place[: size - 1], NONE)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2

        nodes, cells = tree.reshape(-1), size + 1
        token, following, previous, alive = token.reshape(-1), following.reshape(-1), previous.reshape(-1), live.reshape(-1)

        def update(rows, places, keys):
            node = rows * (2 * size) + size + places
            nodes[node] = keys
            base, node = rows * (2 * size), size + places
            for _ in range(bits):
                node = node >> 1
                below = base + 2 * node
                nodes[base + node] = np.minimum(nodes[below], nodes[below + 1])

        rows = np.arange(n)
        while True:
            least = nodes[rows * (2 * size) + 1]
            going = least < NONE
            rows, least = rows[going], least[going]
            if not len(rows):
                break
            at, merged, row = least & (size - 1), least >> bits, rows * cells
            gone = following[row + at]
            after = following[row + gone]
            before = previous[row + at]
            token[row + at] = merged
            following[row + at] = after
            previous[row + after] = at
            alive[rows * size + gone] = False
            rank = self._rank_of(merged, token[row + after])
            update(rows, gone, NONE)
            update(rows, at, np.where((after < end) & (rank < NONE), rank << bits | at, NONE))
            some = before < end
            rows_b, before = rows[some], before[some]
            rank = self._rank_of(token[rows_b * cells + before], merged[some])
            update(rows_b, before, np.where(rank < NONE, rank << bits | before, NONE))

        counts = live.sum(1).tolist()
        ids = map(str, token.reshape(n, cells)[:, :size][live].tolist())
        return (" ".join(islice(ids, k)) for k in counts)

    def encode_long(self, piece: bytes) -> list[int]:
        """Token ids of one piece of any length."""
        n = len(piece)
        size = 1 << max(1, (n - 1).bit_length())
        token = [*self.byte_rank[np.frombuffer(piece, np.uint8)].tolist(), 0]
        following, previous = [*range(1, n + 1), n], list(range(-1, n))
        never = (int(NONE), 0)
        tree = [never] * (2 * size)

        def key(at: int) -> tuple[int, int]:
            after = following[at]
            rank = self.pairs.get(token[at] << 32 | token[after]) if after < n else None
            return never if rank is None else (rank, at)

        def update(at: int, value: tuple[int, int]) -> None:
            node = size + at
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        for at in range(n - 1):
            tree[size + at] = key(at)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != never:
            rank, at = tree[1]
            gone = following[at]
            token[at], following[at] = rank, following[gone]
            if following[at] < n:
                previous[following[at]] = at
            update(gone, never)
            update(at, key(at))
            if previous[at] >= 0:
                update(previous[at], key(previous[at]))
        ids, at = [], 0
        while at < n:
            ids.append(token[at])
            at = following[at]
        return ids


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The process's encoder, so that batches share its cache."""
    return Encoder(path, pattern)


def portions(texts: Iterable[bytes | None]) -> Iterator[list[str]]:
    """Texts in runs of bounded size."""
    run, size = [], 0
    for text in texts:
        run.append((text or b"").decode("utf-8", "replace"))
        size += len(run[-1])
        if size > TEXT_AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of every row, the ids as decimals joined by one space.

    ``path`` names a rank file on the executors (lines of a base64 token and its rank), ``pattern`` the expression that
    cuts texts into pieces. No special tokens. Null and empty texts have no ids. Rows are neither joined nor moved:
    repeated rows give repeated results, an empty table an empty one, and other columns take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            done = 0
            for texts in portions(_bytes(batch.column(1))):
                ids = pa.array(own.encode(texts), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), ids], ["doc_id", "ids"])
                done += len(texts)

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids string")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` of a result of :func:`encode`: the bytes its ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            texts = pa.array([own.decode(ids.as_py() or "") for ids in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids string, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)``: :func:`encode`, then :func:`decode` of its ids, in one pass over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            done = 0
            for texts in portions(_bytes(batch.column(1))):
                ids = own.encode(texts)
                decoded = pa.array(map(own.decode, ids), pa.binary())
                own_ids = batch.column(0).slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([own_ids, pa.array(ids, pa.string()), decoded], ["doc_id", "ids", "decoded"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids string, decoded binary")


def _bytes(column: pa.Array) -> Iterator[bytes | None]:
    return (value.as_py() for value in column)
