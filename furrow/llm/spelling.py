"""Variants of spelling: words one edit apart, and the frequent word that each rare one stands for.

Letters fall into groups by code point. A word's vector of group counts is its path in a trie, a level per group. One
edit changes the vector by at most one letter too many (surplus) and one too few (deficit), so a depth-first search that
spends a budget of one each reaches the leaf of every near word; words at leaves are then verified letter by letter.

The first levels of the trie are a shuffle: words are placed in the branch that their counts name, and asked for in the
branches that one surplus, or one surplus and one deficit, leads to. Of a pair one word asks, so every pair is found
once. There are as many first levels as the number of words calls for. A branch of many words is dealt out in
blocks, its words against its questions, as a grid. Inside a block one depth-first search carries all questions along:
a node keeps those that still have the budget for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.schemas import require_columns
from furrow.workspace import materialize

GROUPS = 32  # a letter's group is its code point modulo this
# Fixed order of the levels: the letters of Latin texts from the most frequent on, so that early levels part most.
FREQUENT = "eainrtsolucdmphgbfvkywzjxq"
LEVELS = [ord(c) % GROUPS for c in FREQUENT] + sorted(set(range(GROUPS)) - {ord(c) % GROUPS for c in FREQUENT})
MOST_LEVELS = 10  # in a branch's number, 6 bits each
WORDS_TO_A_BLOCK = 30_000
QUESTIONS_TO_A_BLOCK = 150_000
LEAF = 8  # words at which the trie ends early
WIDE = 40  # letters up to which words are verified together
PAIRS_AT_ONCE = 100_000

PLACED = pa.schema([("branch", pa.int64()), ("spent", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
PLACED_SCHEMA = "branch long, spent byte, word string, n long"
# What a question has spent on the way to its branch; words are placed, not asked.
STORED, NOTHING, SURPLUS, BOTH = range(4)
NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
NEAR_SCHEMA = "word string, n_near long, form_n long, form string"


def variants(words: DataFrame, ratio: int = 5, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every distinct word of ``words``.

    Two words are near if one inserted, deleted or replaced code point makes one of the other. ``form`` is the near word
    of largest ``n``, of several the first in code-point order, if that is at least ``ratio`` (above one) times the
    word's own, and else null, as is ``form_n``, its ``n``. ``root`` is what following forms from the word ends at, the
    word itself if it has none. ``n_near`` counts near words. Rows of one word are one word, their ``n`` summed; null
    and empty words and null counts are left out. An empty table gives an empty result; other columns take no part.
    """
    if ratio <= 1:
        raise ValueError("with a ratio of one or less forms could go round in a circle")
    require_columns(words, [word_col, n_col])
    own = words.select(words[word_col].cast("string").alias("word"), words[n_col].cast("long").alias("n"))
    own = own.where("word != '' and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    own = materialize(own, "words")
    found = near_words(own)
    good = F.col("form_n") >= ratio * F.col("n")
    formed = own.join(found, "word", "left").select(
        "word",
        F.when(good, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(good, F.col("form_n")).alias("form_n"),
    )
    formed = materialize(formed, "words-with-forms")
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    root = F.coalesce("root", "word").alias("root")
    return formed.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by steps of doubling length.

    A form is more frequent by the ratio than its word, so a chain has no more words than the largest count has
    digits to that base, and the rounds are as few as that number's binary digits.
    """
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.join(on, "root", "left")
        moved = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, form_n, form)`` of the words that have near words; ``words`` are distinct, with their ``n``."""
    count = words.count()
    levels = min(MOST_LEVELS, max(2, (count // WORDS_TO_A_BLOCK).bit_length()))
    placed = words.select("word", "n").mapInArrow(lambda batches: _places(batches, levels), PLACED_SCHEMA)
    placed = materialize(placed, "words-placed")
    stored, asked = placed.where(F.col("spent") == STORED), placed.where(F.col("spent") != STORED)
    sizes = placed.groupBy("branch").agg(
        _blocks(F.col("spent") == STORED, WORDS_TO_A_BLOCK).alias("blocks"),
        _blocks(F.col("spent") != STORED, QUESTIONS_TO_A_BLOCK).alias("turns"),
    )
    sizes = materialize(sizes.where("blocks > 0 and turns > 0"), "branches")
    block, turn = F.pmod(F.xxhash64("word"), F.col("blocks")), F.pmod(F.xxhash64("word", "spent"), F.col("turns"))
    whole = ["branch", "block", "turn"]
    stored = stored.join(sizes, "branch").select("branch", block.alias("block"), "spent", "word", "n", "turns")
    stored = stored.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"))
    asked = asked.join(sizes, "branch").select("branch", turn.alias("turn"), "spent", "word", "n", "blocks")
    asked = asked.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    rows = [t.select(*whole, "spent", "word", "n") for t in (stored, asked)]
    found = rows[0].unionByName(rows[1]).groupBy(*whole).applyInArrow(lambda table: _near(table, levels), NEAR_SCHEMA)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _blocks(which: Column, most: int) -> Column:
    return F.ceil(F.count_if(which) / most)


class _Words:
    """Words as numbers: code points, lengths and counts of letter groups in the order of the levels."""

    def __init__(self, words: pa.Array):
        self.list = words.to_pylist()
        self.sizes = np.fromiter(map(len, self.list), np.int64, len(self.list))
        self.letters = np.frombuffer("".join(self.list).encode("utf-32-le"), np.uint32)
        self.starts = np.cumsum(self.sizes) - self.sizes
        rank = np.empty(GROUPS, np.int64)
        rank[LEVELS] = np.arange(GROUPS)
        owner = np.repeat(np.arange(len(self.list)), self.sizes)
        cells = np.bincount(owner * GROUPS + rank[self.letters % GROUPS], minlength=GROUPS * len(self.list))
        # Numbers wrap around, and so do their differences: one more stays one more.
        self.counts = cells.reshape(-1, GROUPS).astype(np.uint16)

    def square(self) -> tuple[np.ndarray, np.ndarray]:
        """The first ``WIDE`` letters of each word, from the front and from the back, then zeros."""
        column = np.arange(WIDE)
        inside = column < self.sizes[:, None]
        last = max(0, len(self.letters) - 1)
        letters = self.letters if len(self.letters) else np.zeros(1, np.uint32)
        front = np.where(inside, letters[np.minimum(self.starts[:, None] + column, last)], 0)
        back = np.where(inside, letters[np.maximum((self.starts + self.sizes)[:, None] - 1 - column, 0)], 0)
        return front, back


def _places(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Each word in its branch, and in those where it asks for near words.

    For two near words either the counts of the first levels are the same (both ask; the word that is later in order
    counts), or one has one letter more (it asks), or each has one that the other lacks (that asks whose surplus is at
    the earlier level).
    """
    steps = [(STORED, None, None), (NOTHING, None, None), *((SURPLUS, level, None) for level in range(levels))]
    steps += [(BOTH, more, less) for more, less in combinations(range(levels), 2)]
    for batch in batches:
        own = _Words(batch.column(0))
        counts = own.counts[:, :levels].astype(np.int64)
        for spent, more, less in steps:
            path, which = counts.copy(), np.ones(len(counts), bool)
            if more is not None:
                which = path[:, more] > 0
                path[:, more] -= 1
            if less is not None:
                path[:, less] += 1
            branch = ((path & 63) << (6 * np.arange(levels))).sum(1)
            mask = pa.array(which)
            kinds = pa.array(np.full(int(which.sum()), spent, np.int8))
            columns = [pa.array(branch[which]), kinds, batch.column(0).filter(mask), batch.column(1).filter(mask)]
            yield pa.RecordBatch.from_arrays(columns, schema=PLACED)


def _near(table: pa.Table, levels: int) -> pa.Table:
    """Near words inside a block of a branch, summed up by word."""
    spent = table.column("spent").to_numpy()
    if (spent == STORED).all() or (spent != STORED).all():
        return NEAR.empty_table()
    coded = table.column("word").combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()  # by code point
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = rank[coded.indices.to_numpy()]
    words = _Words(coded.dictionary.take(pa.array(order)))
    n = np.empty(len(order), np.int64)
    n[number] = table.column("n").to_numpy()

    stored, asked, by = number[spent == STORED], number[spent != STORED], spent[spent != STORED]
    paths = np.ascontiguousarray(words.counts[stored].astype(">u2")).view(f"V{2 * GROUPS}").ravel()
    stored = stored[np.argsort(paths, kind="stable")]
    squares, found = words.square(), []
    for who, place in _reached(words, stored, asked, by, levels):
        for at in range(0, len(who), PAIRS_AT_ONCE):
            a, b = asked[who[at : at + PAIRS_AT_ONCE]], stored[place[at : at + PAIRS_AT_ONCE]]
            once = (a > b) | ((a != b) & (by[who[at : at + PAIRS_AT_ONCE]] != NOTHING))
            a, b = a[once], b[once]
            near = _one_edit(words, squares, a, b)
            found.append((a[near], b[near]))
    if not found:
        return NEAR.empty_table()
    a, b = map(np.concatenate, zip(*found))
    own, near = np.append(a, b), np.append(b, a)
    order = np.lexsort((near, -n[near], own))
    own, near = own[order], near[order]
    firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))[: len(own)]
    counts = np.diff(np.append(firsts, len(own)))
    text = pa.array(words.list, pa.string())
    columns = [text.take(pa.array(own[firsts])), pa.array(counts, pa.int64()), pa.array(n[near[firsts]], pa.int64())]
    return pa.Table.from_arrays([*columns, text.take(pa.array(near[firsts]))], schema=NEAR)


def _reached(
    words: _Words, stored: np.ndarray, asked: np.ndarray, by: np.ndarray, levels: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in ``asked`` and ``stored`` (sorted by path) that the search reaches, some at a time."""
    paths, wanted = words.counts[stored], words.counts[asked]
    surplus, deficit = (by == NOTHING).astype(np.int8), (by != BOTH).astype(np.int8)
    nodes = [(0, len(stored), levels, np.arange(len(asked)), surplus, deficit)]
    held, size = [], 0
    while nodes:
        lo, hi, level, who, surplus, deficit = nodes.pop()
        if hi - lo <= LEAF:
            pairs = np.repeat(who, hi - lo), np.tile(np.arange(lo, hi), len(who))
        elif level == GROUPS:
            pairs = _halves(words, stored[lo:hi], asked[who])
            pairs = who[pairs[0]], lo + pairs[1]
        else:
            column = paths[lo:hi, level]
            cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), hi - lo]
            own = wanted[who, level]
            for a, b in zip(cuts, cuts[1:]):
                more = (own - column[a]).view(np.int16)
                stay = (more == 0) | ((more == 1) & (surplus > 0)) | ((more == -1) & (deficit > 0))
                if stay.any():
                    spend = more[stay]
                    left = surplus[stay] - (spend == 1), deficit[stay] - (spend == -1)
                    nodes.append((lo + a, lo + b, level + 1, who[stay], *left))
            continue
        held.append(pairs)
        size += len(pairs[0])
        if size > PAIRS_AT_ONCE:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _halves(words: _Words, stored: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At a leaf of many words, which are all of one length: pairs with the same first or the same last half.

    An edit leaves one of the two halves of the shorter word as it is.
    """
    texts = [words.list[i] for i in stored.tolist()]
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(asked.tolist()):
        by_length.setdefault(int(words.sizes[word]), []).append(i)
    pairs = set()
    for length, members in by_length.items():
        half = min(length, len(texts[0])) // 2
        for part in (slice(half), slice(-half, None)) if half else (slice(0),):
            places: dict[str, list[int]] = {}
            for place, text in enumerate(texts):
                places.setdefault(text[part], []).append(place)
            for i in members:
                pairs.update((i, place) for place in places.get(words.list[asked[i]][part], ()))
    found = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _one_edit(words: _Words, squares: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether distinct words are one edit apart: the letters they share in front and at the back leave one at most."""
    longer = np.maximum(words.sizes[a], words.sizes[b])
    apart = np.abs(words.sizes[a] - words.sizes[b])
    near = apart <= 1
    short = np.flatnonzero(near & (longer <= WIDE))
    shared = np.zeros(len(short), np.int64)
    least = np.minimum(words.sizes[a[short]], words.sizes[b[short]])
    for square in squares:
        differ = square[a[short]] != square[b[short]]
        shared += np.minimum(np.where(differ.any(1), differ.argmax(1), WIDE), least)
    near[short] = shared >= longer[short] - 1
    for i in np.flatnonzero(near & (longer > WIDE)).tolist():
        near[i] = _one_edit_apart(words.list[a[i]], words.list[b[i]])
    return near


def _one_edit_apart(a: str, b: str) -> bool:
    """The same for two words of any length."""
    if len(a) < len(b):
        a, b = b, a
    low, high = 0, len(b)  # how many letters they share in front
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + 1 :] == b[low + (len(a) == len(b)) :]
