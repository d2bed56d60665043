"""Encoding and decoding by a SentencePiece model of merge type (BPE).

A token ends the encoding of a prefix of a text if the token before it ends the encoding of what the prefix has in
front of it, and the two tokens stay two when their joined text is encoded. Of all tokens that end at a place, exactly
one does so. So a table keeps, for every prefix, its unique last token: an automaton over the vocabulary names the
tokens that end at each place, and a test of the pair picks the one. The ids are read off the table backwards.

Characters that no piece holds stand alone and become byte tokens; no merge reaches across them, nor to a blank from
the character before it, if no piece of the vocabulary does. Texts are cut there, and each cut part is encoded once.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from furrow.llm.byte_bpe import portions
from furrow.llm.tables import Remembered, documents, values

BLANK = "▁"  # stands for a space inside pieces
REMEMBERED = 250_000  # parts of texts per generation of the cache
REMEMBERED_PAIRS = 1_000_000
LONGEST_REMEMBERED = 200  # characters
CLASSES = 3  # sets of characters between which texts are cut
UNKNOWN = -1
BYTES, END_OF_RUN = re.compile("[\udc80-\udcff]+"), "\udc00"
# Kinds of pieces and the kind of model, as the format numbers them.
NORMAL, UNKNOWN_KIND, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2


def _number(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        byte = data[at]
        at, out, shift = at + 1, out | (byte & 127) << shift, shift + 7
        if byte < 128:
            return out, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a message in the protocol buffer format."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({5: 4, 1: 8}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class Model:
    """What a model file holds: pieces by id, their kinds and ranks (0 merges first), and whether texts get a blank in front."""

    pieces: list[str]
    kinds: list[int]
    ranks: list[float]
    blank_in_front: bool

    @classmethod
    def read(cls, path: str) -> Model:
        """Only models of merge type with byte tokens, which take texts as they are, are read; others raise."""
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        entries = [dict(_fields(v)) for k, v in fields if k == 1]
        trainer = next((dict(_fields(v)) for k, v in fields if k == 2), {})
        rules = next((dict(_fields(v)) for k, v in fields if k == 3), {})
        kinds = [e.get(3, NORMAL) for e in entries]
        plain = not rules.get(2) and not rules.get(4, 1) and rules.get(5, 1)
        if trainer.get(3, 1) != MERGE_TYPE or not plain or trainer.get(24, 0) or {USER, UNUSED} & set(kinds) or kinds.count(BYTE) != 256:
            raise ValueError(f"{path} is no model of merge type with byte tokens that takes texts as they are")
        ranks = [-struct.unpack("<f", e.get(2, b"\0\0\0\0"))[0] for e in entries]
        return cls([e[1].decode("utf-8") for e in entries], kinds, ranks, bool(rules.get(3, 1)))


class _Pairs(dict):
    """Whether two tokens stay two beside each other, remembered by pair."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= REMEMBERED_PAIRS:
            self.clear()
        known = self[pair] = self.coder.stay_two(*pair)
        return known


class _Parts(Remembered):
    """Ids of parts of texts, as :meth:`Coder.coded` gives them; long parts are not remembered."""

    def __init__(self, coder: Coder):
        super().__init__(REMEMBERED)
        self.coder = coder

    def __missing__(self, part: str) -> str:
        if len(part) > LONGEST_REMEMBERED:
            return self.coder.coded(part)
        self.turn()
        found = self.old.get(part)
        known = self[part] = self.coder.coded(part) if found is None else found
        return known


class Coder:
    """Encodes and decodes with the model file at ``path``."""

    def __init__(self, path: str):
        self.model = model = Model.read(path)
        self.ids = {piece: i for i, piece in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        if not set(chain.from_iterable(self.ids)) <= self.ids.keys():
            raise ValueError(f"{path} has pieces of characters that are no pieces")
        self.bytes = {_byte(model.pieces[i]): i for i, kind in enumerate(model.kinds) if kind == BYTE}
        self.ends = {i for i, kind in enumerate(model.kinds) if kind == CONTROL}
        # How a token is made: the pair of its last merge. A token that its own text does not encode to never occurs.
        self.made: dict[int, tuple[int, int] | None] = {}
        for piece, i in self.ids.items():
            steps = self._merged(piece)
            if len(steps[0]) == 1:
                self.made[i] = steps[1]
        self.pairs = {pair: i for i, pair in self.made.items() if pair}
        # Tokens of ranks of their own that follow those of all they are made of; only these allow the test at the seam.
        shared: dict[float, int] = {}
        for i in self.pairs.values():
            shared[model.ranks[i]] = shared.get(model.ranks[i], 0) + 1
        self.ordered: dict[int, bool] = {}
        for i in sorted(self.made, key=lambda i: len(model.pieces[i])):
            pair = self.made[i]
            self.ordered[i] = pair is None or (
                shared[model.ranks[i]] == 1
                and all(self.ordered[p] and (self.made[p] is None or model.ranks[p] < model.ranks[i]) for p in pair)
            )
        self.automaton = ahocorasick.Automaton()
        for i in self.made:
            self.automaton.add_word(model.pieces[i], i)
        self.automaton.make_automaton()
        self.sizes = list(map(len, model.pieces))
        self.names = list(map(str, range(len(model.pieces))))
        self.beside = _Pairs(self)
        self.known = _Parts(self)
        # Parts that no merge crosses the ends of: a run of blanks and what follows, a character that no piece holds.
        apart = not any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        classes = ["[" + "".join(map(re.escape, sorted(held))) + "]" for held in _classes(self.ids)]
        runs = "|".join(f"{letters}+" for letters in classes)
        cut = f"{BLANK}*(?:{runs})|{BLANK}+|." if apart else f"(?:{BLANK}|{'|'.join(classes)})+|."
        self.find = re.compile(cut, re.DOTALL).findall
        self.surface = {str(i): piece.replace(BLANK, " ") for i, piece in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        self.surface.update((str(i), "") for i in self.ends)
        self.surface.update((str(i), " ⁇ ") for i, kind in enumerate(model.kinds) if kind == UNKNOWN_KIND)
        # Byte tokens of ASCII are their character whatever is beside them; the others wait as lone surrogates.
        self.surface.update((str(i), bytes([value]).decode("ascii", "surrogateescape")) for value, i in self.bytes.items())
        self.parted = self.surface | dict.fromkeys(map(str, self.ends), END_OF_RUN)  # bytes do not join across a control piece

    # Texts

    def encode(self, texts: list[str], end: int | None = None) -> list[str]:
        """Token ids of each text as decimals joined by one space, with the id ``end`` after them."""
        front = BLANK if self.model.blank_in_front else ""
        tail = [] if end is None else [str(end)]
        known = self.known.__getitem__
        return [" ".join([*map(known, self.find(front + text.replace(" ", BLANK)) if text else ()), *tail]) for text in texts]

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text with ``BLANK`` for spaces."""
        return list(map(int, self.coded(part).split()))

    def coded(self, part: str) -> str:
        """Ids of a text with ``BLANK`` for spaces, by the table of last tokens, as decimals joined by one space."""
        whole, names = self.ids.get(part), self.names
        if whole in self.made:
            return names[whole]
        # Last tokens by their last characters; None at characters that no piece holds, and before the first: the place
        # in front of the text is read as the text's end, whose token is found last of all.
        last: list[int | None] = [None] * len(part)
        sizes, beside = self.sizes, self.beside
        for at, token in self.automaton.iter(part):
            if last[at] is None:
                before = last[at - sizes[token]]
                if before is None or beside[before, token]:
                    last[at] = token
        out, at = [], len(part) - 1
        while at >= 0:
            token = last[at]
            if token is None:
                out.extend(names[self.bytes[b]] for b in reversed(part[at].encode("utf-8", "replace")))
                at -= 1
            else:
                out.append(names[token])
                at -= sizes[token]
        out.reverse()
        return " ".join(out)

    def decode(self, ids: str) -> str:
        """The text of ids given as by :meth:`encode`. Bytes that are no UTF-8 become U+FFFD each."""
        if not ids:
            return ""
        tokens = ids.split(" ")
        text = "".join(map(self.surface.__getitem__, tokens))
        try:
            text.encode("utf-8")  # faster than a look for surrogates
        except UnicodeEncodeError:
            text = _read("".join(map(self.parted.__getitem__, tokens)))
        return text[1:] if self.model.blank_in_front and text.startswith(" ") and self._starts_blank(tokens) else text

    def _starts_blank(self, tokens: list[str]) -> bool:
        """Whether the first piece that is no control piece begins with a blank, which then stands for no space."""
        for token in tokens:
            if int(token) not in self.ends:
                return self.model.pieces[int(token)].startswith(BLANK)
        return False

    # Pairs

    def stay_two(self, left: int, right: int) -> bool:
        """Whether the joined text of two tokens encodes to just these two."""
        if self.ordered[left] and self.ordered[right]:
            return self._seam(left, right)
        return self._merged(self.model.pieces[left] + self.model.pieces[right])[0] == [left, right]

    def _seam(self, left: int, right: int) -> bool:
        """:meth:`stay_two` for ordered tokens: undo their merges at the seam, latest first.

        No merge across the seam may come before the one of the two tokens' own merges that takes its parts away. Of
        merges of one rank the leftmost comes first.
        """
        pairs, made, ranks = self.pairs, self.made, self.model.ranks
        until_left = until_right = float("inf")
        while True:
            across = pairs.get((left, right))
            if across is not None and ranks[across] < until_left and ranks[across] <= until_right:
                return False
            of_left, of_right = made[left], made[right]
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and ranks[left] > ranks[right]):
                until_left, left = ranks[left], of_left[1]
            else:
                until_right, right = ranks[right], of_right[0]

    def _merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Tokens of a short text by merging pairs one after another, and the last pair merged."""
        ids, ranks, pieces = self.ids, self.model.ranks, self.model.pieces
        tokens, last = [ids.get(c, UNKNOWN) for c in text], None
        while True:
            best = None
            for i in range(len(tokens) - 1):
                if tokens[i] != UNKNOWN and tokens[i + 1] != UNKNOWN:
                    merged = ids.get(pieces[tokens[i]] + pieces[tokens[i + 1]])
                    if merged is not None and (best is None or ranks[merged] < best[0]):
                        best = ranks[merged], i, merged
            if best is None:
                return tokens, last
            _, i, merged = best
            last = tokens[i], tokens[i + 1]
            tokens[i : i + 2] = [merged]


def _classes(pieces: Iterable[str]) -> list[set[str]]:
    """The characters of pieces, but for ``BLANK``, in up to ``CLASSES`` sets of which no piece has two side by side."""
    beside: dict[str, set[str]] = {}
    for piece in pieces:
        letters = piece.strip(BLANK)
        for a, b in zip(letters, letters[1:] or letters):
            beside.setdefault(a, set()).add(b)
            beside.setdefault(b, set()).add(a)
    found, waiting = [], set(beside) - {BLANK}
    while waiting:
        reached, fresh = set(), {waiting.pop()}
        while fresh:
            reached |= fresh
            fresh = set().union(*map(beside.get, fresh)) - reached - {BLANK}
        waiting -= reached
        found.append(reached)
    found.sort(key=len, reverse=True)
    rest = set().union(*found[CLASSES - 1 :])
    return [*found[: CLASSES - 1], *[rest] * bool(rest)]


def _byte(piece: str) -> int:
    """The value of a byte token's name, such as ``<0x0A>``."""
    return int(piece[1:-1], 16)


def _read(text: str) -> str:
    """A text with its runs of lone surrogates, which stand for bytes, read as UTF-8."""
    return BYTES.sub(lambda run: _text(run[0].encode("ascii", "surrogateescape")), text).replace(END_OF_RUN, "")


def _text(run: bytes) -> str:
    """Bytes as UTF-8, U+FFFD for each byte that belongs to no character."""
    out = []
    while run:
        try:
            return "".join(out) + run.decode("utf-8")
        except UnicodeDecodeError as wrong:
            out.append(run[: wrong.start].decode("utf-8") + "�")
            run = run[wrong.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """The process's coder, so that batches share its caches."""
    return Coder(path)


def encode(docs: DataFrame, path: str, end: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` of every row, the ids as decimals joined by one space, with the id ``end`` after each text's.

    ``path`` names a model file on the executors. Null and empty texts have no ids but ``end``. Texts are read whole,
    whatever their length. Rows are neither joined nor moved: repeated rows give repeated results, an empty table an
    empty one, and other columns take no part.
    """
    return _run(documents(docs, id_col, text_col), path, end, decoded=False)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` of a result of :func:`encode`: the text its ids stand for, empty for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            texts = pa.array([own.decode(ids or "") for ids in values(batch.column(1))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids string, decoded string")


def round_trip(
    docs: DataFrame, path: str, end: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, ids, decoded)``: :func:`encode`, then :func:`decode` of its ids, in one pass over the rows."""
    return _run(documents(docs, id_col, text_col), path, end, decoded=True)


def _run(texts: DataFrame, path: str, end: int | None, decoded: bool) -> DataFrame:
    names = ["doc_id", "ids", "decoded"][: 3 if decoded else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            done = 0
            for part in portions(values(batch.column(1))):
                ids = own.encode(part, end)
                columns = [batch.column(0).slice(done, len(part)), pa.array(ids, pa.string())]
                if decoded:
                    columns.append(pa.array(map(own.decode, ids), pa.string()))
                done += len(part)
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(run, "doc_id long, ids string" + ", decoded string" * decoded)
