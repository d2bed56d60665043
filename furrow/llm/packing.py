"""Vector bin packing of training examples into sequences.

A sequence has simultaneous limits on its tokens, its segments and its loss-bearing tokens. The open sequence takes, of
a window of waiting examples, the one that fits with the largest dot product of its demand and the free capacity, each
as a share of the limits. Every task packs the rows it has, so no row is moved.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.tables import Remembered, documents, released, slices, values
from furrow.schemas import require_columns

WINDOW = 1024  # examples that wait for a place
REMEMBERED = 300_000  # words per generation of the cache
WORDS_TO_A_TEXT, FRESH_AT_ONCE = 50, 10_000
MARK = " \0 "  # between words that are encoded together; words that hold it are encoded alone
# The vocabulary's pattern always ends a token between these; an apostrophe may belong to the letters after it, and a
# dotted I in lower case ends in a combining dot.
LETTER_BEFORE_MARK = r"([0-9A-Za-zÀ-ÖØ-öø-įı-ɏ])([!-&(-/:-@\[-`{-~])", r"\1 \2"
TEXT_AT_ONCE = 2_000_000  # bytes
ROWS_AT_ONCE = 2_000
TASK_SHIFT = 40  # sequence ids: the task's number above this bit, its sequences below
PIECES_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
EXAMPLES_SCHEMA = "example_id long, length long, loss_tokens long, sequence_id long, offset long"
ARROW = {"long": pa.int64(), "binary": pa.binary()}
PIECES, EXAMPLES = (
    pa.schema([(name, ARROW[kind]) for name, kind in map(str.split, text.split(", "))])
    for text in (PIECES_SCHEMA, EXAMPLES_SCHEMA)
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


@dataclass
class Piece:
    """Part of an example: ``length`` tokens from ``start`` on."""

    example: int
    start: int
    length: int
    loss: int


class Packer:
    """Packs a run of examples; ``sequences`` are handed out as they close.

    With ``cut`` an example may be divided: the open sequence is filled with the head of one when nothing fits whole,
    and what stays short at the end is divided into sequences whose lengths are powers of two. All tokens of an example
    that is cut bear loss. Without ``cut`` an example that exceeds a limit alone has a sequence of its own.
    """

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut = limits, cut
        self.most = min(limits.tokens, limits.loss_tokens)
        self.scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.waiting: list[Piece] = []

    def add(self, example: int, tokens: int, loss: int) -> Iterator[list[Piece]]:
        start = 0
        if self.cut:
            while tokens - start >= self.most:
                yield [Piece(example, start, self.most, self.most)]
                start += self.most
            loss = tokens - start
        elif tokens > self.limits.tokens or loss > self.limits.loss_tokens:
            yield [Piece(example, 0, tokens, loss)]
            return
        if tokens > start:
            self.waiting.append(Piece(example, start, tokens - start, loss))
        if len(self.waiting) >= 2 * WINDOW:
            yield from self._pack(WINDOW)

    def rest(self) -> Iterator[list[Piece]]:
        yield from self._pack(0)

    def _pack(self, until: int) -> Iterator[list[Piece]]:
        waiting = self.waiting
        length = np.array([p.length for p in waiting])
        loss = np.array([p.loss for p in waiting])
        demand = np.stack([length, np.ones(len(waiting)), loss], 1) / self.scale
        left = len(waiting)
        while left > until:
            free = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens])
            opened: list[Piece] = []
            while left and free[0] > 0 and free[1] > 0 and (free[2] > 0 or not self.cut):
                fits = (length <= free[0]) & (loss <= free[2])
                score = np.where(fits, demand @ (free / self.scale), -1.0)
                best = int(score.argmax())
                if score[best] >= 0:
                    piece, waiting[best] = waiting[best], None
                    length[best] = np.iinfo(np.int64).max  # never fits again
                    left -= 1
                elif self.cut:
                    best = int(np.where(length < np.iinfo(np.int64).max, length, -1).argmax())
                    whole, head = waiting[best], int(min(free[0], free[2]))
                    piece = Piece(whole.example, whole.start, head, head)
                    waiting[best] = Piece(whole.example, whole.start + head, whole.length - head, whole.length - head)
                    length[best] = loss[best] = whole.length - head
                    demand[best] = np.array([length[best], 1, loss[best]]) / self.scale
                else:
                    break
                opened.append(piece)
                free -= [piece.length, 1, piece.loss]
            yield from self._closed(opened)
        self.waiting = [p for p in waiting if p is not None]

    def _closed(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        total = sum(p.length for p in pieces)
        if not self.cut:
            yield pieces
            return
        pieces = pieces[::-1]
        while total:
            size = self.limits.tokens if total == self.limits.tokens else 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                piece = pieces.pop()
                if piece.length > size:
                    pieces.append(Piece(piece.example, piece.start + size, piece.length - size, piece.length - size))
                    piece = Piece(piece.example, piece.start, size, size)
                part.append(piece)
                size -= piece.length
            yield part


class WordTokens:
    """Token ids of texts by a vocabulary file of ``tokenizers`` that lower-cases and drops white space.

    Words between ASCII blanks are encoded once and remembered, for neither the file's normalisers nor its pattern
    reach across a blank, nor from a letter to an ASCII mark after it: words are cut there too, so that one is known with
    any marks behind it. Fresh words are encoded many to a text, with a mark that is a token of its own between them.
    With ``specials`` the names of special tokens in a text are those tokens, as by the file's own default, and such a
    text is encoded whole; else they are ordinary words.
    """

    def __init__(self, path: str, specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known = Remembered(REMEMBERED)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        added = self.tokenizer.get_added_tokens_decoder().values() if specials else ()
        names = [token.content for token in added if token.special]
        self.specials, self.sign = "|".join(map(re.escape, names)), os.path.commonprefix(names)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text. Words are cut and numbered by Arrow, so that Python sees each of a portion's words once."""
        texts = texts.cast(pa.string()).fill_null("")
        # A look for the sign that all names begin with is much cheaper than one for the names.
        if self.specials and pc.any(pc.match_substring(texts, self.sign)).as_py():
            named = pc.match_substring_regex(texts, self.specials)
            if pc.any(named).as_py():
                out = self._words(pc.if_else(named, "", texts))
                at = np.flatnonzero(named.to_numpy(zero_copy_only=False)).tolist()
                for i, ids in zip(at, self._whole([texts[i].as_py() for i in at])):
                    out[i] = ids
                return out
        return self._words(texts)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        self.tokenizer.encode_special_tokens = False
        try:
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        finally:
            self.tokenizer.encode_special_tokens = True
        return [np.array(c.ids, "<u4") for c in coded]

    def _words(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(words.dictionary, *LETTER_BEFORE_MARK))
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        self.known[""] = b""
        self._learn(self.known.unknown(distinct))
        parts = list(map(self.known.__getitem__, distinct))
        ids, lengths = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        ids, ends = _strung(ids, lengths, numbered.indices.to_numpy())
        ids, ends = _strung(ids, np.diff(ends[cut.offsets.to_numpy()]), words.indices.to_numpy())
        at = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, fresh: list[str]) -> None:
        for at in range(0, len(fresh), FRESH_AT_ONCE):
            part = fresh[at : at + FRESH_AT_ONCE]
            odd = [word for word in part if "\0" in word]
            plain = [word for word in part if "\0" not in word] if odd else part
            runs = [plain[i : i + WORDS_TO_A_TEXT] for i in range(0, len(plain), WORDS_TO_A_TEXT)]
            texts = [MARK.join(run) for run in runs]
            for run, coded in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(coded.ids, "<u4")
                marks = np.flatnonzero(ids == self.mark)
                cuts, ids = (4 * marks).tolist(), ids.tobytes()
                self.known.update((word, ids[a:b]) for word, a, b in zip(run, [0, *(c + 4 for c in cuts)], [*cuts, len(ids)]))
            for word, coded in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
                self.known[word] = np.array(coded.ids, "<u4").tobytes()


def _strung(ids: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids``, of these ``lengths``, one after another in ``order``, and where each ends, after a 0."""
    counts, starts = lengths[order], (np.cumsum(lengths) - lengths)[order]
    ends = np.concatenate([[0], np.cumsum(counts)])
    # Each run is shifted to where its ids stand.
    at = np.repeat((starts - ends[:-1]).astype(np.int32), counts)
    at += np.arange(ends[-1], dtype=np.int32)
    return ids[at], ends


@lru_cache(maxsize=2)
def word_tokens(path: str, specials: bool = False) -> WordTokens:
    """The process's encoder, so that batches share its cache."""
    return WordTokens(path, specials)


def pack_documents(
    docs: DataFrame,
    path: str,
    limits: Limits = Limits(),
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    specials: bool = False,
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` of all documents, packed.

    ``path`` names a vocabulary file of ``tokenizers`` on the executors; ``ids`` are little-endian unsigned 32-bit
    numbers; ``end_id`` follows every document. Null text counts as empty. Every id lies in one piece; a document
    without ids (empty, and no ``end_id``) has no piece. Repeated rows are packed once each, an empty table gives no
    piece, and other columns take no part. All tokens bear loss. With ``specials`` the names of special tokens in a
    text give those tokens, as the file's tokenizer does by default; else they are encoded as ordinary words.
    """
    end = np.array([] if end_id is None else [end_id], "<u4")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, own = Packer(limits, cut=True), word_tokens(path, specials)
        held: dict[int, tuple[int | None, np.ndarray, int]] = {}  # example -> id, token ids, tokens not yet handed out

        def sequences() -> Iterator[list[Piece]]:
            example = 0
            for batch in batches:
                coded = chain.from_iterable(map(own.encode, slices(batch.column(1), TEXT_AT_ONCE)))
                for name, ids in zip(values(batch.column(0)), coded):
                    ids = np.concatenate([ids, end])
                    if len(ids):
                        held[example] = (name, ids, len(ids))
                        yield from packer.add(example, len(ids), len(ids))
                    example += 1
            yield from packer.rest()

        def pieces() -> Iterator[tuple]:
            for piece, sequence, offset in _numbered(sequences()):
                name, ids, left = held.pop(piece.example)
                if left > piece.length:
                    held[piece.example] = (name, ids, left - piece.length)
                part = ids[piece.start : piece.start + piece.length].tobytes()
                yield name, piece.start, piece.length, part, len(ids), sequence, offset

        yield from _batches(pieces(), PIECES)

    return documents(docs, id_col, text_col).mapInArrow(run, PIECES_SCHEMA)


def pack_examples(
    examples: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "example_id",
    tokens_col: str = "tokens",
    loss_col: str = "loss_tokens",
) -> DataFrame:
    """``(example_id, length, loss_tokens, sequence_id, offset)``: uncut examples, packed by their counts.

    For instruction data, where only some tokens bear loss. An example above a limit has a sequence of its own; one
    whose token count is null or not positive has no place (null sequence and offset). Null loss counts as none.
    """
    require_columns(examples, [id_col, tokens_col, loss_col])
    counts = examples.select(
        examples[id_col].cast("long").alias("example_id"),
        F.greatest(F.coalesce(examples[tokens_col].cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        F.greatest(F.coalesce(examples[loss_col].cast("long"), F.lit(0)), F.lit(0)).alias("loss"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut=False)
        names: dict[int, int | None] = {}
        empty: list[tuple] = []

        def sequences() -> Iterator[list[Piece]]:
            rows = chain.from_iterable(zip(*map(values, batch.columns)) for batch in batches)
            for example, (name, length, loss) in enumerate(rows):
                if length:
                    names[example] = name
                    yield from packer.add(example, length, loss)
                else:
                    empty.append((name, 0, loss, None, None))
            yield from packer.rest()

        def pieces() -> Iterator[tuple]:
            for piece, sequence, offset in _numbered(sequences()):
                yield names.pop(piece.example), piece.length, piece.loss, sequence, offset
                while empty:
                    yield empty.pop()
            yield from empty

        yield from _batches(pieces(), EXAMPLES)

    return counts.mapInArrow(run, EXAMPLES_SCHEMA)


def _numbered(sequences: Iterable[list[Piece]]) -> Iterator[tuple[Piece, int, int]]:
    """Each piece with its sequence's id, which no other task gives, and its offset there."""
    for number, pieces in enumerate(sequences, TaskContext.get().partitionId() << TASK_SHIFT):
        offset = 0
        for piece in pieces:
            yield piece, number, offset
            offset += piece.length


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while run := list(islice(rows, ROWS_AT_ONCE)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*run), schema)], schema=schema)
