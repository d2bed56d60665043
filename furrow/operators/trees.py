"""Ensembles of trees grown to their end: forests, extremely random trees, and boosting with second-order gains.

Spark ML's own learners grow trees level by level over the whole table, to a depth of 30 at most, and send the trees that
have grown so far with every task. The learners here take a bounded number of labelled rows (``rows_to_fit``), which one
task can hold, and hand the rows over: a group of a forest's trees, or a boosted ensemble, gets all of them and
finishes its trees without another pass over the data. Trees are as deep as their rows make them.

Without a bound (``rows_to_fit=None``) every labelled row takes part, in the same way if a task can hold all of them.
Otherwise a forest's nodes of more rows than a task takes are split by passes over the table, which sum labels by node and
bin; the rows of smaller ones are handed over and their subtrees grown to the end. Boosting then keeps the rows as bins in
the tasks, which sum gradients for a level of a tree at a time; the driver gets those sums and chooses the splits.

What comes back is a table of nodes, a row per node. A boosted ensemble's is stored in the format of Spark ML's own
models, so its scoring is Spark's, in the JVM. A forest of full-grown trees has millions of nodes, which Spark's model
would hold as objects on the driver; :class:`ForestModel` keeps them as a stored table and scores with packed arrays.
"""

from __future__ import annotations

import json
import math
import pickle
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from heapq import heappop, heappush, nsmallest
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from furrow.schemas import LABEL
from furrow.workspace import materialize, new_path, prepare_checkpoints

ROWS_TO_FIT = 20_000
TREES_TO_A_TASK = 8  # of a forest, at least: its rows are handed over once for them
MOST_TREES_TO_A_TASK = 32
TASKS_TO_A_THREAD = 4
ROWS_TO_A_TASK = 250_000  # of a node that one task grows to the end
BOOSTED_ROWS_TO_A_TASK = 500_000  # up to which one task boosts sooner than a job for each level of a tree
ROWS_TO_A_BLOCK = 25_000  # of which a task sums labels or gradients, at least
MOST_ROWS_TO_A_BLOCK = 500_000
ROWS_HANDED_OVER = 100_000_000  # times the trees that are grown at once
ROUNDS_KEPT = 25  # of boosting, between checkpoints
CUTS_OF_MANY = 256  # of a number in a node of more rows than a task takes
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
MOST_CELLS = 1_000_000  # of nodes by slots that are counted without a sort
NODE = pa.schema(
    [
        ("tree", pa.int32()), ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
        ("stats", pa.list_(pa.float64())), ("rows", pa.int64()), ("gain", pa.float64()), ("left", pa.int32()),
        ("right", pa.int32()), ("feature", pa.int32()), ("threshold", pa.float64()),
    ]
)
# A node's second child follows its first.
FOREST = pa.schema(
    [
        ("tree", pa.int32()), ("id", pa.int32()), ("left", pa.int32()), ("feature", pa.int32()), ("threshold", pa.float64()),
        ("share", pa.float64()), ("won", pa.float64()),
    ]
)
# Label sums of the rows of a node by bin, and what follows of them.
CELLS = pa.schema(
    [("tree", pa.int32()), ("node", pa.int32()), ("bin", pa.int32()), ("rows", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64())]
)
CELLS_SCHEMA = "tree int, node int, bin int, rows long, zeros double, ones double"
CHOICE = pa.schema(
    [
        ("tree", pa.int32()), ("node", pa.int32()), ("share", pa.float64()), ("won", pa.float64()), ("bin", pa.int32()),
        ("left", pa.int64()), ("right", pa.int64()),
    ]
)
CHOICE_SCHEMA = "tree int, node int, share double, won double, bin int, left long, right long"
FOREST_SCHEMA = "tree int, id int, left int, feature int, threshold double, share double, won double"
NODE_SCHEMA = (
    "tree int, id int, prediction double, impurity double, stats array<double>, rows long, gain double, left int, right int, "
    "feature int, threshold double"
)


def sample_rows(rows: DataFrame, most: int | None, seed: int, label: str = LABEL) -> DataFrame:
    """About ``most`` rows of a stored table, or all if there are no more or ``most`` is null; each label keeps its share.

    Rows are drawn one by one, copies too, and rows without label stay out.
    """
    rows = rows.where(F.col(label).isNotNull())
    if most is None or (total := rows.count()) <= most:
        return rows
    # Seeded by partition, so a task that is run again draws the same rows of a stored table.
    return rows.where(F.rand(seed) < most / total)


@dataclass
class Rows:
    """Training rows of one task: dense columns of numbers, and the places of ones in columns of zeros and ones."""

    label: np.ndarray
    weight: np.ndarray
    width: int  # of the vectors
    numbers: np.ndarray  # a row per number column
    number_of: np.ndarray  # the vector's slot of each number column
    hot_row: np.ndarray  # rows and slots of ones, by row
    hot_slot: np.ndarray

    def __post_init__(self) -> None:
        # The place of every number among the distinct ones of its column.
        ranks = [np.unique(v, return_inverse=True)[1] for v in self.numbers]
        self.ranks = np.array(ranks, np.int64).reshape(self.numbers.shape)

    @classmethod
    def read(cls, table: pa.Table, number_of: np.ndarray | None = None) -> Rows:
        """From columns ``label, weight, features, place``; the order of the rows follows ``place``, not their arrival.

        Numbers are in the slots ``number_of``, or those with a value that is neither zero nor one.
        """
        table = table.sort_by([("place", "ascending"), ("label", "ascending"), ("weight", "ascending")]).combine_chunks()
        features = table.column("features").combine_chunks()
        row, slot, value = vector_entries(features)
        known = features.field("size").drop_null()
        width = known[0].as_py() if len(known) else int(slot.max(initial=-1)) + 1
        row, slot, value = row[value != 0], slot[value != 0], value[value != 0]
        number_of = np.unique(slot[value != 1]) if number_of is None else number_of
        column = np.full(width, -1)
        column[number_of] = np.arange(len(number_of))
        numbers = np.zeros((len(number_of), len(table)))
        inside = column[slot] >= 0
        numbers[column[slot[inside]], row[inside]] = value[inside]
        label, weight = (table.column(c).to_numpy() for c in ("label", "weight"))
        return cls(label.astype(np.int64), weight, width, numbers, number_of, row[~inside], slot[~inside])


def with_probability(dataset: DataFrame, ones: Column) -> DataFrame:
    """Columns that Spark's classifiers add, from the probability of label 1."""
    p = F.col("_p")
    both = array_to_vector(F.array(1 - p, p))
    added = {"rawPrediction": both, "probability": both, "prediction": (p > 0.5).cast("double")}
    return dataset.withColumn("_p", ones).withColumns(added).drop("_p")


class _Nodes:
    """Nodes of one boosted tree in the order they are made, parents first."""

    def __init__(self, tree: int):
        self.tree, self.rows = tree, []

    def add(self, prediction: float, impurity: float, stats: list[float], rows: int) -> int:
        at = len(self.rows)
        self.rows.append([self.tree, at, prediction, impurity, stats, rows, -1.0, -1, -1, -1, 0.0])
        return at

    def split(self, at: int, gain: float, left: int, right: int, feature: int, threshold: float) -> None:
        self.rows[at][6:] = [gain, left, right, feature, threshold]


def _table(nodes: list[_Nodes]) -> pa.Table:
    columns = zip(*(row for tree in nodes for row in tree.rows))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE)], schema=NODE)


# Forests


def grow_tree(
    rows: Rows, tree: int, random: np.random.Generator, bootstrap: bool, random_cuts: bool, per_node: int, copies: np.ndarray | None = None
) -> pa.Table:
    """One tree of a forest, a level at a time, until its leaves are of one label or cannot be parted.

    ``copies`` are the rows' counts in the tree's sample, if they are drawn already.

    ``per_node`` features that are not constant in a node are tried, or as many of them as a draw of ``per_node`` from
    all features would hold, but at least one. With ``random_cuts`` a number is cut at a random place between its least
    and largest value in the node, which the sums of labels on both sides judge; else at the best place.
    """
    n = len(rows.label)
    if copies is None:
        copies = np.bincount(random.integers(0, n, n), minlength=n) if bootstrap else np.ones(n, np.int64)
    weight = rows.weight * copies
    hot_starts = np.searchsorted(rows.hot_row, np.arange(n + 1))
    own = np.flatnonzero(copies)
    node, count, made, levels = np.zeros(len(own), np.int64), 1, 1, []
    while count:
        sums = np.bincount(2 * node + rows.label[own], weight[own], 2 * count).reshape(-1, 2)
        drawn = np.bincount(node, copies[own], count)
        total = sums.sum(1)
        left, won = np.full(count, -1), np.full(count, -1.0)
        feature, threshold = np.full(count, -1), np.zeros(count)
        levels.append((left, feature, threshold, sums[:, 1] / np.maximum(total, 1e-300), won))
        open_ = np.flatnonzero((sums > 0).all(1) & (drawn >= 2))
        name = np.full(count, -1)
        name[open_] = np.arange(len(open_))
        keep = name[node] >= 0
        own, node = own[keep], name[node[keep]]
        if not len(own):
            break
        order = np.argsort(node)
        own, node = own[order], node[order]
        by, cut, score, right = _level(rows, own, node, weight, sums[open_], hot_starts, random, random_cuts, per_node)
        split = np.flatnonzero(by >= 0)
        at, count = open_[split], 2 * len(split)
        left[at] = made + 2 * np.arange(len(split))
        feature[at], threshold[at] = by[split], cut[split]
        won[at] = np.maximum(score[split] - _score(sums[at]), 0)
        made += count
        child = np.full(len(open_), -1)
        child[split] = 2 * np.arange(len(split))
        keep = child[node] >= 0  # rows of a node that cannot be parted are done
        own, node = own[keep], (child[node] + right)[keep]
    columns = [np.concatenate(x) for x in zip(*levels)]
    arrays = [np.full(made, tree), np.arange(made), *columns]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, FOREST)], schema=FOREST)


def _level(rows, own, node, weight, sums, hot_starts, random, random_cuts, per_node):
    """Best split of every node of a level: its feature (-1: none), threshold and score, and which rows go right."""
    count, starts = len(sums), np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    label, w = rows.label[own], weight[own]
    size = np.bincount(node, minlength=count)
    # Ones: the label sums of the rows that have them, by node and slot.
    held = np.diff(hot_starts)[own]
    ends = np.cumsum(held)
    entry = np.repeat(hot_starts[own] - (ends - held), held) + np.arange(ends[-1] if len(ends) else 0)
    at = np.repeat(np.arange(len(own)), held)
    slot = rows.hot_slot[entry]
    key = node[at] * rows.width + slot
    if count * rows.width <= MOST_CELLS:
        held = np.bincount(key, minlength=count * rows.width)
        hot = np.bincount(2 * key + label[at], w[at], 2 * count * rows.width).reshape(-1, 2)
        key = np.flatnonzero(held)
        held, hot = held[key], hot[key]
    else:  # a wide vector: only the cells that occur
        key, which, held = np.unique(key, return_inverse=True, return_counts=True)
        hot = np.bincount(2 * which + label[at], w[at], 2 * len(key)).reshape(-1, 2)
    some = held < size[key // rows.width]
    tried = [(key[some] // rows.width, key[some] % rows.width, hot[some], np.full(some.sum(), 0.5))]
    low, high = (
        [f.reduceat(rows.numbers[j, own], starts) for j in range(len(rows.numbers))] for f in (np.minimum, np.maximum)
    )
    changing = [np.flatnonzero(a < b) for a, b in zip(low, high)]
    number = np.concatenate([np.full(len(c), j) for j, c in enumerate(changing)] or [np.empty(0, int)]).astype(np.int64)
    owner = np.concatenate([tried[0][0], *changing]).astype(np.int64)

    # Features to try: those first in a random order, and as many as a draw from all would hold.
    before = random.random(len(owner))
    order = np.lexsort((before, owner))
    changing_count = np.bincount(owner, minlength=count)
    place = np.empty(len(owner), np.int64)
    place[order] = np.arange(len(owner)) - np.repeat(np.cumsum(changing_count) - changing_count, changing_count)
    wanted = random.hypergeometric(changing_count, rows.width - changing_count, min(per_node, rows.width))
    chosen = place < np.maximum(wanted, 1)[owner]

    ones = len(tried[0][0])
    found = [(*(x[chosen[:ones]] for x in tried[0]), before[:ones][chosen[:ones]])]
    for j in range(len(rows.numbers)):
        mine = np.flatnonzero((number == j) & chosen[ones:])
        of = owner[ones + mine]
        if not len(of):
            continue
        value = rows.numbers[j, own]
        if random_cuts:
            cut = np.zeros(count)
            cut[of] = low[j][of] + random.random(len(of)) * (high[j][of] - low[j][of])
            cut[of] = np.where(cut[of] >= high[j][of], low[j][of], cut[of])
            right = np.bincount(2 * node + label, w * (value > cut[node]), 2 * count).reshape(-1, 2)[of]
            found.append((of, np.full(len(of), rows.number_of[j]), right, cut[of], before[ones + mine]))
        else:
            asked = np.zeros(count, bool)
            asked[of] = True
            of_cut, right, cut = _best_cuts(asked[node], node, value, rows.ranks[j, own], label, w, sums)
            rank = np.zeros(count)
            rank[of] = before[ones + mine]
            found.append((of_cut, np.full(len(of_cut), rows.number_of[j]), right, cut, rank[of_cut]))
    owner, features, right, cuts, before = (np.concatenate(x) for x in zip(*found))
    score = _score(sums[owner] - right) + _score(right)
    best = np.lexsort((before, -score, owner))
    best = best[np.append(True, owner[best][1:] != owner[best][:-1])] if len(best) else best
    feature, threshold, scores = np.full(count, -1), np.zeros(count), np.zeros(count)
    feature[owner[best]], threshold[owner[best]], scores[owner[best]] = features[best], cuts[best], score[best]

    column = np.full(rows.width + 1, -1)
    column[rows.number_of] = np.arange(len(rows.number_of))
    numeric = column[feature]
    goes = np.zeros(len(own), np.int64)
    goes[at[slot == feature[node[at]]]] = 1
    by_number = numeric[node] >= 0
    if by_number.any():
        goes[by_number] = rows.numbers[numeric[node[by_number]], own[by_number]] > threshold[node[by_number]]
    return feature, threshold, scores, goes


def _score(sums: np.ndarray) -> np.ndarray:
    """Sum of squares of the label sums over their total: the larger, the purer."""
    return (sums**2).sum(1) / np.maximum(sums.sum(1), 1e-300)


def _best_cuts(inside, node, value, rank, label, w, sums):
    """Per node, the cut between two values that leaves the purest sides: nodes, label sums right of it, and cuts."""
    inside = np.flatnonzero(inside)
    order = inside[np.argsort(node[inside] * (rank.max(initial=0) + 1) + rank[inside])]
    node, value, label, w = node[order], value[order], label[order], w[order]
    firsts = np.append(True, node[1:] != node[:-1])
    upto = np.stack([np.cumsum(w * (label == c)) for c in (0, 1)], 1)
    before = np.concatenate([np.zeros((1, 2)), upto])[:-1][firsts]  # of earlier nodes
    left = upto - before[np.cumsum(firsts) - 1]
    at = np.flatnonzero((node[1:] == node[:-1]) & (value[1:] > value[:-1]))
    right = np.maximum(sums[node[at]] - left[at], 0.0)
    score = _score(left[at]) + _score(right)
    best = np.lexsort((at, -score, node[at]))
    best = best[np.append(True, node[at][best][1:] != node[at][best][:-1])]
    at, right = at[best], right[best]
    middle = (value[at] + value[at + 1]) / 2
    return node[at], right, np.where(middle < value[at + 1], middle, value[at])


# Boosting


@dataclass(frozen=True)
class Growth:
    """How a boosted tree grows: to a depth or to a number of leaves, and what a split must leave on both sides.

    ``by_residuals`` chooses splits by the variance of the gradients and takes hessians for the leaves' values only.
    """

    depth: int | None = None
    leaves: int | None = None
    l2: float = 0.0
    least_hessian: float = 0.0
    least_rows: int = 1
    by_residuals: bool = False


class Bins:
    """Rows as codes into one row of bins: some for each number column, then one per column of ones, then none."""

    def __init__(self, cuts: list[np.ndarray], number_of: np.ndarray, slots: np.ndarray):
        """``cuts`` of the number columns in the vector's slots ``number_of``, and the slots of ones."""
        self.cuts, self.number_of, self.slots = cuts, number_of, slots
        self.starts = starts = np.cumsum([0, *(len(c) + 1 for c in cuts)], dtype=np.int64)
        ones, self.size = int(starts[-1]), int(starts[-1]) + len(slots) + 1
        # By bin: the vector's slot, the threshold, the first bin of its column, and whether a split may stand there.
        self.ones = np.arange(self.size) >= ones
        columns = np.repeat(np.arange(len(cuts)), np.diff(starts))
        self.first = starts[columns]
        self.feature = np.concatenate([number_of[columns], slots, [-1]]).astype(np.int64)
        self.threshold = np.full(self.size, 0.5)
        self.allowed = np.ones(self.size, bool)
        self.allowed[-1] = False
        for j, middles in enumerate(cuts):
            self.threshold[starts[j] : starts[j + 1]] = np.append(middles, np.inf)
            self.allowed[starts[j + 1] - 1] = False
        self.column = np.concatenate([columns, np.full(self.size - ones, -1)])

    @classmethod
    def of(cls, rows: Rows, most: int) -> Bins:
        """Bins of some rows, and the rows' codes, a row of them per column."""
        cuts = []
        for value in rows.numbers:
            distinct = np.unique(value)
            middles = (distinct[1:] + distinct[:-1]) / 2
            if len(middles) >= most:
                middles = np.unique(np.quantile(value, np.arange(1, most) / most, method="midpoint"))
            cuts.append(middles)
        bins = cls(cuts, rows.number_of, np.unique(rows.hot_slot))
        bins.codes = np.ascontiguousarray(bins.coded(rows).T, np.int32)
        return bins

    def coded(self, rows: Rows) -> np.ndarray:
        """The bins of each row, a column for each number and as many as a row has ones."""
        n, starts = len(rows.label), self.starts
        codes = [start + np.searchsorted(middles, value, "left") for start, middles, value in zip(starts, self.cuts, rows.numbers)]
        held = np.bincount(rows.hot_row, minlength=n)
        padded = np.full((held.max(initial=0), n), self.size - 1)
        place = np.arange(len(rows.hot_slot)) - np.repeat(np.cumsum(held) - held, held)
        padded[place, rows.hot_row] = starts[-1] + np.searchsorted(self.slots, rows.hot_slot)
        return np.concatenate([np.array(codes, np.int64).reshape(-1, n), padded]).T.copy()

    def goes_right(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which rows go right of a split at a bin of their own."""
        column = self.column[at]
        number = codes[np.arange(len(codes)), np.maximum(column, 0)] > at
        return np.where(column >= 0, number, (codes == at[:, None]).any(1))

    def leaves(self, codes: np.ndarray, split: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The node that each row ends in: nodes are split at a bin (-1: none), and a second child follows the first."""
        node, going = np.zeros(len(codes), np.int64), np.arange(len(codes) if split[0] >= 0 else 0)
        while len(going):
            at = node[going]
            node[going] = left[at] + self.goes_right(codes[going], split[at])
            going = going[split[node[going]] >= 0]
        return node

    def left_of(self, sums: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """What stands left of a split at each bin, from sums by bin in the last axis and their totals."""
        numbers = len(self.first)
        upto = np.cumsum(sums[:, :numbers], 1)
        left = totals[:, None] - sums
        left[:, :numbers] = upto - (upto - sums[:, :numbers])[:, self.first]
        return left

    def sums(self, own: np.ndarray, *values: np.ndarray | None) -> np.ndarray:
        """Sums by bin of some rows' values, each array summed once however often it is given; of None, the numbers of rows."""
        measured = {id(v): None if v is None else v[own] for v in values}
        found, ends = {key: np.zeros(self.size) for key in measured}, [*self.starts[1:], self.size]
        for j, column in enumerate(self.codes):
            first, end = self.starts[min(j, len(self.cuts))], ends[min(j, len(self.cuts))]
            codes = np.subtract(column[own], first, dtype=np.int64)
            for key, v in measured.items():
                found[key][first:end] += np.bincount(codes, v, end - first)
        return np.stack([found[id(v)] for v in values])

    def right(self, own: np.ndarray, at: int) -> np.ndarray:
        """Which of the rows go right of a split at a bin."""
        if self.ones[at]:
            return (self.codes[len(self.cuts) :, own] == at).any(0)
        return self.codes[self.column[at], own] > at


def best_split(bins: Bins, sums: np.ndarray, totals: np.ndarray, allowed: np.ndarray, growth: Growth) -> tuple[int, float, np.ndarray] | None:
    """The bin of the best split, what it wins, and the totals left of it.

    ``sums`` by bin and ``totals`` are of the gradients, the hessians, what gains are divided by, and the rows.
    """
    left = bins.left_of(sums, totals)
    right = totals[:, None] - left
    good = allowed & (np.minimum(left[3], right[3]) >= growth.least_rows)
    good &= np.minimum(left[1], right[1]) >= growth.least_hessian
    parts = [s[0] ** 2 / (s[2] + growth.l2 + 1e-12) for s in (left, right)]
    gain = np.where(good, parts[0] + parts[1], -np.inf)
    split = int(gain.argmax())
    won = gain[split] - totals[0] ** 2 / (totals[2] + growth.l2 + 1e-12)
    return (split, won, left[:, split]) if good[split] and won > 1e-10 else None


def boosted_tree(
    bins: Bins, gradient: np.ndarray, hessian: np.ndarray, taken: np.ndarray, columns: np.ndarray, growth: Growth, nodes: _Nodes
) -> np.ndarray:
    """One tree on the rows ``taken``, best split first; returns every row's value.

    ``columns`` tells by bin whether its feature takes part. A split's gain is what it adds to the sum over the sides
    of ``gradient ** 2 / (hessian + l2)``; a leaf's value is ``-gradient / (hessian + l2)``.
    """
    n, measured = len(gradient), (gradient, hessian, None if growth.by_residuals else hessian, None)
    queue, leaf_of, kept = [], np.zeros(n, np.int64), {}
    allowed = bins.allowed & columns

    def open_node(own: np.ndarray, sums: np.ndarray, totals: np.ndarray, depth: int) -> int:
        at = nodes.add(-totals[0] / (totals[1] + growth.l2 + 1e-12), 0.0, [float(len(own)), 0.0, 0.0], len(own))
        kept[at] = own
        if (growth.depth is None or depth < growth.depth) and len(own) >= 2 * growth.least_rows:
            if found := best_split(bins, sums, totals, allowed, growth):
                heappush(queue, (-found[1], at, found[0], depth, sums, totals))
        return at

    def all_of(own: np.ndarray) -> np.ndarray:
        return np.array([len(own) if v is None else v[own].sum() for v in measured], float)

    open_node(taken, bins.sums(taken, *measured), all_of(taken), 0)
    left_out, leaves = np.ones(n, bool), 1
    left_out[taken] = False
    others = {0: np.flatnonzero(left_out)}  # rows that are not taken, by the node they would be in
    while queue and (growth.leaves is None or leaves < growth.leaves):
        won, at, split, depth, sums, totals = heappop(queue)
        own, rest = kept.pop(at), others.pop(at)
        goes = bins.right(own, split)
        sides = own[~goes], own[goes]
        small, both = int(len(sides[1]) < len(sides[0])), [None, None]
        # Children that are leaves by their depth need totals only.
        part = sums if depth + 1 == growth.depth else bins.sums(sides[small], *measured)
        part_totals = all_of(sides[small])
        both[small], both[1 - small] = (part, part_totals), (sums - part, totals - part_totals)
        children = [open_node(side, *own_sums, depth + 1) for side, own_sums in zip(sides, both)]
        goes = bins.right(rest, split)
        others[children[0]], others[children[1]] = rest[~goes], rest[goes]
        nodes.split(at, -won / max(1, len(own)), *children, int(bins.feature[split]), float(bins.threshold[split]))
        leaves += 1
    for members in (kept, others):
        for at, rows in members.items():
            leaf_of[rows] = at
    return np.array([row[2] for row in nodes.rows])[leaf_of]


def boost(rows: Rows, rounds: int, rate: float, row_share: float, column_share: float, growth: Growth, most_bins: int, from_prior: bool, seed: int) -> list[_Nodes]:
    """Trees for the log odds of label 1, whose values hold the rate and, the first one's, the starting log odds."""
    bins, label = Bins.of(rows, most_bins), rows.label.astype(float)
    random = np.random.default_rng(seed)
    share = min(max(label.mean(), 1e-6), 1 - 1e-6)
    start = math.log(share / (1 - share)) if from_prior else 0.0
    margin, trees, n = np.full(len(label), start), [], len(label)
    for tree in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        taken = np.arange(n) if row_share >= 1 else np.flatnonzero(random.random(n) < row_share)
        nodes = _Nodes(tree)
        margin += rate * boosted_tree(bins, p - label, p * (1 - p), taken, _drawn_columns(bins, column_share, random), growth, nodes)
        _to_model(nodes, rate, start if tree == 0 else 0.0)
        trees.append(nodes)
    return trees


def _drawn_columns(bins: Bins, share: float, random: np.random.Generator) -> np.ndarray:
    """By bin, whether its feature takes part in a tree."""
    names = np.unique(bins.feature[bins.allowed])
    if share >= 1 or not len(names):
        return np.ones(bins.size, bool)
    return np.isin(bins.feature, random.choice(names, max(1, round(share * len(names))), replace=False))


def _to_model(nodes: _Nodes, rate: float, start: float) -> None:
    for row in nodes.rows:  # the model's probability is that of twice its margin
        row[2] = (rate * row[2] + start) / 2


# All rows


def with_features_bare(rows: DataFrame) -> DataFrame:
    """Vectors as plain structs, which tasks may hand on."""
    udt = isinstance(rows.schema["features"].dataType, VectorUDT)
    return rows.withColumn("features", F.unwrap_udt("features")) if udt else rows


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """All batches of a task as one table, if there are any."""
    if held := list(batches):
        yield pa.Table.from_batches(held)


def fit_bins(rows: DataFrame, width: int, most: int) -> Bins:
    """Bins of all rows of a table of vectors: each value of a number for itself, or about even ones if there are more than ``most``.

    The driver gets the slots of numbers and, for each, fewer than ``most`` cuts.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, slot, value = vector_entries(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(slot[(value != 0) & (value != 1)]), pa.int32())], ["slot"])

    features = with_features_bare(rows.select("features"))
    number_of = np.array(sorted(r["slot"] for r in features.mapInArrow(slots, "slot int").distinct().collect()), np.int64)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = _dense(batch.column(0), number_of)
            columns = [pa.array(np.tile(number_of, len(dense)), pa.int32()), pa.array(dense.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "value"])

    cuts = {}
    if len(number_of):
        values = features.mapInArrow(numbers, "slot int, value double")
        distinct = materialize(values.distinct(), "number-values")
        counts = dict(distinct.groupBy("slot").count().collect())
        few, many = ([slot for slot, n in counts.items() if (n <= most) == small] for small in (True, False))
        for r in distinct.where(F.col("slot").isin(few)).groupBy("slot").agg(F.array_sort(F.collect_list("value"))).collect():
            exact = np.array(r[1])
            cuts[r[0]] = (exact[1:] + exact[:-1]) / 2
        if many:
            shares = [i / most for i in range(1, most)]
            sketch = values.where(F.col("slot").isin(many)).groupBy("slot").agg(F.percentile_approx("value", shares, 10_000))
            cuts |= {r[0]: np.unique(r[1]) for r in sketch.collect()}
    return Bins([cuts[slot] for slot in number_of.tolist()], number_of, np.setdiff1d(np.arange(width), number_of))


def _parts(count: int, rows: DataFrame) -> int:
    """In how many parts the tasks take that many rows."""
    wanted = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-count // MOST_ROWS_TO_A_BLOCK))
    return max(1, min(wanted, -(-count // ROWS_TO_A_BLOCK)))


def boost_all(rows: DataFrame, bins: Bins, rounds: int, rate: float, row_share: float, column_share: float, growth: Growth, from_prior: bool, seed: int) -> list[_Nodes]:
    """:func:`boost` on every row of a table ``(label, weight, features, place)``, whose tasks keep them as codes."""
    prepare_checkpoints(rows.sparkSession)
    count, share = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not count:
        raise ValueError("no labelled rows to fit boosted trees on")
    share = min(max(share, 1e-6), 1 - 1e-6)
    start = math.log(share / (1 - share)) if from_prior else 0.0
    shared = rows.sparkSession.sparkContext.broadcast(bins)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            own = Rows.read(table, shared.value.number_of)
            block = shared.value.coded(own).astype(np.int32), own.label.astype(np.int8), np.full(len(own.label), start), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    blocks = with_features_bare(rows).repartition(_parts(count, rows)).mapInArrow(coded, "block binary")
    state = blocks.rdd.map(lambda r: pickle.loads(r["block"])).persist(StorageLevel.MEMORY_AND_DISK)
    before, trees, random = None, [], np.random.default_rng(seed)
    for tree in range(rounds):
        columns = bins.allowed & _drawn_columns(bins, column_share, random)
        nodes = _Nodes(tree)
        split, left = _grown(state, shared, bins, nodes, columns, growth, row_share, [seed, tree])
        if before is not None:
            before.unpersist()
        before = state
        state = state.map(_moved(shared, split, left, rate * np.array([row[2] for row in nodes.rows])))
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if tree % ROUNDS_KEPT == ROUNDS_KEPT - 1:
            state.checkpoint()  # else what a lost task has to repeat would grow with every round
        _to_model(nodes, rate, start if tree == 0 else 0.0)
        trees.append(nodes)
    for rdd in (before, state):
        if rdd is not None:
            rdd.unpersist()
    return trees


def _moved(shared, split: np.ndarray, left: np.ndarray, values: np.ndarray):
    def moved(block: tuple) -> tuple:
        codes, label, margin, number = block
        return codes, label, margin + values[shared.value.leaves(codes, split, left)], number

    return moved


def _grown(state: RDD, shared, bins: Bins, nodes: _Nodes, allowed: np.ndarray, growth: Growth, row_share: float, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """One tree, as :func:`boosted_tree` grows it; returns the bin (-1: none) and the first child of every node.

    Of a node that is to be split, the sums by bin of the rows that would go left are asked for, of as many nodes at once
    as may still be split; those on the right are what is left of the node's own.
    """
    split, left, queue, known, leaves = [], [], [], {}, 1

    def made(totals: np.ndarray) -> int:
        split.append(-1)
        left.append(-1)
        rows = int(round(totals[3]))
        return nodes.add(-totals[0] / (totals[1] + growth.l2 + 1e-12), 0.0, [float(rows), 0.0, 0.0], rows)

    def judge(at: int, sums: np.ndarray, totals: np.ndarray, depth: int) -> None:
        if (growth.depth is None or depth < growth.depth) and totals[3] >= 2 * growth.least_rows:
            if found := best_split(bins, sums, totals, allowed, growth):
                # Without a bound on leaves all are split, so a level is asked for at a time.
                first = -found[1] if growth.leaves is not None else depth
                heappush(queue, (first, at, found, depth, sums, totals))

    def ends(depth: int) -> bool:
        return growth.depth is not None and depth + 1 >= growth.depth

    def ask(at: list[int], cuts: list[int]) -> np.ndarray:
        asked = _asked(shared, np.array(split or [-1]), np.array(left or [-1]), at, cuts, row_share, seed, growth.by_residuals)
        return state.map(asked).treeReduce(add) if state.getNumPartitions() > 64 else state.map(asked).reduce(add)

    sums = ask([0], [-1])[0]
    sums, totals = sums[:, :-1], sums[:, -1]
    made(totals)
    judge(0, sums, totals, 0)
    while queue and (growth.leaves is None or leaves < growth.leaves):
        if queue[0][1] not in known and not ends(queue[0][3]):
            most = len(queue) if growth.leaves is None else growth.leaves - leaves
            most = min(most, max(1, MOST_CELLS // (4 * bins.size)))
            wanted = [q for q in nsmallest(len(queue), queue) if q[1] not in known and not ends(q[3])][:most]
            found = ask([q[1] for q in wanted], [q[2][0] for q in wanted])
            known |= {q[1]: part[:, :-1] for q, part in zip(wanted, found)}
        _, at, (cut, won, left_totals), depth, sums, totals = heappop(queue)
        children = made(left_totals), made(totals - left_totals)
        split[at], left[at] = cut, children[0]
        nodes.split(at, won / max(1, totals[3]), *children, int(bins.feature[cut]), float(bins.threshold[cut]))
        if not ends(depth):
            part = known.pop(at)
            judge(children[0], part, left_totals, depth + 1)
            judge(children[1], sums - part, totals - left_totals, depth + 1)
        leaves += 1
    return np.array(split), np.array(left)


def _asked(shared, split: np.ndarray, left: np.ndarray, at: list[int], cuts: list[int], row_share: float, seed: list[int], by_residuals: bool):
    """A function from a task's rows to sums by node, measure and bin, and over all bins; of the rows left of ``cuts`` (-1: all)."""
    place, cuts = np.full(len(split), -1), np.array(cuts)
    place[at] = np.arange(len(at))

    def sums(block: tuple) -> np.ndarray:
        codes, label, margin, number = block
        bins = shared.value
        if row_share < 1:
            taken = np.random.default_rng([*seed, number]).random(len(label)) < row_share
            codes, label, margin = codes[taken], label[taken], margin[taken]
        node = place[bins.leaves(codes, split, left)]
        keep = np.flatnonzero(node >= 0)
        cut = cuts[node[keep]]
        keep = keep[(cut < 0) | ~bins.goes_right(codes[keep], np.maximum(cut, 0))]
        codes, node, margin = codes[keep], node[keep], margin[keep]
        p, size = 1 / (1 + np.exp(-margin)), bins.size + 1
        ones, hessian = np.ones(len(p)), p * (1 - p)
        measured = p - label[keep], hessian, ones if by_residuals else hessian, ones
        flat = np.concatenate([node[:, None] * size + codes, node[:, None] * size + size - 1], 1)
        flat, width = flat.ravel(), flat.shape[1]
        found = [np.bincount(flat, np.repeat(v, width), len(at) * size).reshape(len(at), size) for v in measured]
        return np.stack(found, 1)

    return sums


# Estimators


def _width(dataset: DataFrame) -> int:
    return dataset.schema["features"].metadata["ml_attr"]["num_attrs"]


class _Bounded(Estimator):
    """What both learners share: the sample, or all rows, and their hand-over to tasks."""

    rows_to_fit: int | None
    seed: int
    label = LABEL

    def _labelled(self, dataset: DataFrame) -> DataFrame:
        """Label, weight and vector of the rows that the fit uses."""
        weight = F.col("weight").cast("double") if "weight" in dataset.columns else F.lit(1.0)
        rows = dataset.select(F.col(self.label).cast("int").alias("label"), weight.alias("weight"), "features")
        return sample_rows(rows, self.rows_to_fit, self.seed, "label")

    def _handed_over(self, dataset: DataFrame, groups: int) -> DataFrame:
        """The sample, once for each group of trees."""
        sample = self._labelled(dataset).withColumn("place", F.xxhash64("features"))
        group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
        # A partition for each group: how long a group takes does not follow from its bytes.
        return sample.select(group, "label", "weight", "features", "place").repartitionById(groups, "group")


class Forest(_Bounded):
    """Random forest, or extremely random trees, on a bounded number of rows, or all; fits a :class:`ForestModel`."""

    @keyword_only
    def __init__(
        self, *, trees: int, bootstrap: bool = True, random_cuts: bool = False, per_node: int | None = None,
        rows_to_fit: int | None = ROWS_TO_FIT, seed: int = 42,
    ):
        super().__init__()
        self.trees, self.bootstrap, self.random_cuts, self.per_node = trees, bootstrap, random_cuts, per_node
        self.rows_to_fit, self.seed, self.depth = rows_to_fit, seed, None

    def _fit(self, dataset: DataFrame) -> ForestModel:
        trees, bootstrap, random_cuts, per_node, seed = self.trees, self.bootstrap, self.random_cuts, self.per_node, self.seed

        parallel = dataset.sparkSession.sparkContext.defaultParallelism
        together = max(TREES_TO_A_TASK, min(MOST_TREES_TO_A_TASK, -(-trees // (TASKS_TO_A_THREAD * parallel))))

        def grow(key: tuple, table: pa.Table) -> pa.Table:
            rows, first = Rows.read(table), key[0].as_py() * together
            tried = per_node or max(1, math.isqrt(rows.width))
            numbers = range(first, min(trees, first + together))
            grown = [grow_tree(rows, t, np.random.default_rng([seed, t]), bootstrap, random_cuts, tried) for t in numbers]
            return pa.concat_tables(grown)

        if self.rows_to_fit is None and dataset.where(F.col(self.label).isNotNull()).count() > ROWS_TO_A_TASK:
            return ForestModel(self._apart(dataset), trees)
        handed = self._handed_over(dataset, -(-trees // together))
        return ForestModel(materialize(handed.groupBy("group").applyInArrow(grow, FOREST_SCHEMA), "forest"), trees)


    def _apart(self, dataset: DataFrame) -> DataFrame:
        """Nodes of trees on more rows than a task takes: nodes of many rows first, then the subtrees below them."""
        trees, seed, bootstrap, random_cuts, width = self.trees, self.seed, self.bootstrap, self.random_cuts, _width(dataset)
        tried = self.per_node or max(1, math.isqrt(width))
        spark, labelled = dataset.sparkSession, with_features_bare(self._labelled(dataset))
        count = labelled.count()
        placed = labelled.repartition(_parts(count, labelled)).withColumn("place", F.monotonically_increasing_id())
        rows = materialize(placed, "placed")
        shared = spark.sparkContext.broadcast(fit_bins(rows, width, CUTS_OF_MANY))

        def deal(tops: dict[int, _Top], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, codes, place in _coded(batches, shared.value):
                for tree, top in tops.items():
                    copies, own, node = _members(shared.value, codes, place, top, tree, seed, bootstrap)
                    for at in top.open:
                        taken = own[node == at]
                        if len(taken):
                            part = table.take(taken).append_column("copies", pa.array(copies[taken], pa.int64()))
                            for name, value in (("top", at), ("tree", tree)):
                                part = part.add_column(0, name, pa.array(np.full(len(taken), value, np.int32)))
                            yield from part.combine_chunks().to_batches()

        def grow(key: tuple, table: pa.Table) -> pa.Table:
            tree, at = (k.as_py() for k in key)
            table = table.sort_by("place")
            random, copies = np.random.default_rng([seed, tree, at]), table.column("copies").to_numpy()
            grown = grow_tree(Rows.read(table), tree, random, bootstrap, random_cuts, tried, copies)
            return grown.append_column("top", pa.array(np.full(len(grown), at, np.int32)))

        path, every, at_once = new_path(spark, "subtrees"), {}, max(1, ROWS_HANDED_OVER // count)
        for first in range(0, trees, at_once):
            tops = self._tops(rows, shared, range(first, min(trees, first + at_once)), tried)
            every |= tops
            handed = rows.mapInArrow(partial(deal, tops), f"tree int, top int, {rows.schema.toDDL()}, copies long")
            grown = handed.groupBy("tree", "top").applyInArrow(grow, f"{FOREST_SCHEMA}, top int")
            grown.write.mode("append").parquet(path)
        return materialize(_whole_trees(spark.read.schema(f"{FOREST_SCHEMA}, top int").parquet(path), every, shared.value), "forest")

    def _tops(self, rows: DataFrame, shared, trees: range, tried: int) -> dict[int, _Top]:
        """The nodes of more rows than a task takes, and what they are split into; the driver gets a row for each."""
        seed, bootstrap, random_cuts = self.seed, self.bootstrap, self.random_cuts
        tops, asked = {tree: _Top() for tree in trees}, {tree: [0] for tree in trees}

        def cells(asked: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = shared.value
            size = bins.size + 1  # the last cell is for all rows
            for table, codes, place in _coded(batches, bins):
                label, weight = table.column("label").to_numpy(), table.column("weight").to_numpy()
                for tree, (top, at) in asked.items():
                    copies, own, node = _members(bins, codes, place, top, tree, seed, bootstrap)
                    which = np.full(len(top.left), -1)
                    which[at] = np.arange(len(at))
                    own, node = own[which[node] >= 0], which[node[which[node] >= 0]]
                    wide = codes.shape[1] + 1
                    flat = np.concatenate([node[:, None] * size + codes[own], node[:, None] * size + size - 1], 1).ravel()
                    w, ones = np.repeat(copies[own] * weight[own], wide), np.repeat(label[own] == 1, wide)
                    held = np.bincount(flat, minlength=len(at) * size)
                    found = np.flatnonzero(held)
                    sums = [np.bincount(flat[side], w[side], len(at) * size)[found] for side in (~ones, ones)]
                    columns = [np.full(len(found), tree), np.array(at)[found // size], found % size, held[found], *sums]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CELLS)], schema=CELLS)

        def choose(key: tuple, table: pa.Table) -> pa.Table:
            tree, at = (k.as_py() for k in key)
            random = np.random.default_rng([seed, tree, at, 1])
            found = _choice(shared.value, table, random, random_cuts, tried)
            return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip((tree, at, *found), CHOICE)], schema=CHOICE)

        while asked:
            now = {tree: (tops[tree], at) for tree, at in asked.items()}
            counted = rows.mapInArrow(partial(cells, now), CELLS_SCHEMA).groupBy("tree", "node", "bin")
            counted = counted.agg(*[F.sum(c).alias(c) for c in ("rows", "zeros", "ones")])
            asked = {}
            for r in sorted(counted.groupBy("tree", "node").applyInArrow(choose, CHOICE_SCHEMA).collect()):
                for child in tops[r["tree"]].split(r):
                    asked.setdefault(r["tree"], []).append(child)
        return tops


class _Top:
    """The upper nodes of a tree; of those ``open`` the subtree is yet to be grown."""

    def __init__(self):
        self.bin, self.left, self.share, self.won, self.open = [-1], [-1], [0.0], [0.0], []

    def split(self, found: Row) -> list[int]:
        """Take in what was found of a node; returns its children that are too large for a task."""
        at, large = found["node"], []
        self.share[at] = found["share"]
        if found["bin"] >= 0:
            self.bin[at], self.left[at], self.won[at] = found["bin"], len(self.left), found["won"]
            for rows in (found["left"], found["right"]):
                (large if rows > ROWS_TO_A_TASK else self.open).append(len(self.left))
                for column, value in ((self.bin, -1), (self.left, -1), (self.share, 0.0), (self.won, 0.0)):
                    column.append(value)
        return large


def _coded(batches: Iterator[pa.RecordBatch], bins: Bins) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """The rows of a task by their place, their codes and places."""
    for table in _tables(batches):
        table = table.sort_by("place")
        yield table, bins.coded(Rows.read(table, bins.number_of)), table.column("place").to_numpy()


def _members(bins: Bins, codes: np.ndarray, place: np.ndarray, top: _Top, tree: int, seed: int, bootstrap: bool):
    """How often a tree draws each row, the rows that it draws, and the upper node that each of them is in."""
    copies = drawn(place, tree, seed) if bootstrap else np.ones(len(place), np.int64)
    own = np.flatnonzero(copies)
    return copies, own, bins.leaves(codes[own], np.array(top.bin), np.array(top.left))


def drawn(place: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Draws from the Poisson distribution of mean 1, which depend on a row's place, the tree and the seed alone."""
    x = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.random.SeedSequence([seed, tree]).generate_state(1, np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(POISSON, ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53, "right")


def _choice(bins: Bins, cells: pa.Table, random: np.random.Generator, random_cuts: bool, tried: int) -> tuple:
    """Of a node's sums by bin: the share of label 1, what the best split wins, its bin (-1: none), and the rows on its sides."""
    sums, at = np.zeros((3, bins.size + 1)), cells.column("bin").to_numpy()
    for to, name in zip(sums, ("rows", "zeros", "ones")):
        to[at] = cells.column(name).to_numpy()
    sums, totals = sums[:, :-1], sums[:, -1]
    share = totals[2] / max(totals[1] + totals[2], 1e-300)
    left = bins.left_of(sums, totals)
    right = totals[:, None] - left
    good = bins.allowed & (left[0] > 0.5) & (right[0] > 0.5)
    features = np.unique(bins.feature[good])
    if not len(features) or totals[1] <= 0 or totals[2] <= 0:
        return share, 0.0, -1, 0, 0
    width = len(bins.number_of) + len(bins.slots)
    wanted = max(1, random.hypergeometric(len(features), width - len(features), min(tried, width)))
    good &= np.isin(bins.feature, random.choice(features, wanted, replace=False))
    if random_cuts:
        for j in np.unique(bins.column[good & ~bins.ones]):
            inside = np.flatnonzero(good & (bins.column == j))
            place = random.uniform(bins.threshold[inside[0]], bins.threshold[inside[-1]])
            good[inside] = inside == inside[np.searchsorted(bins.threshold[inside], place)]
    score = np.where(good, sum(_score(np.maximum(side[1:].T, 0)) for side in (left, right)), -np.inf)
    best = int(random.choice(np.flatnonzero(score == score.max())))
    won = max(score[best] - _score(totals[None, 1:])[0], 0.0)
    return share, won, best, int(round(left[0, best])), int(round(right[0, best]))


def _whole_trees(subtrees: DataFrame, tops: dict[int, _Top], bins: Bins) -> DataFrame:
    """Upper nodes and the subtrees below them as trees of one numbering: a subtree's root has the place kept for it."""
    spark, upper = subtrees.sparkSession, []
    for tree, top in tops.items():
        kept = sorted(set(range(len(top.left))) - set(top.open))
        upper += [(tree, i, top.left[i], int(bins.feature[b]) if (b := top.bin[i]) >= 0 else -1, float(bins.threshold[b]) if b >= 0 else 0.0, top.share[i], top.won[i] if b >= 0 else -1.0) for i in kept]
    sizes = spark.createDataFrame([(tree, len(top.left)) for tree, top in tops.items()], "tree int, size int")
    before = Window.partitionBy("tree").orderBy("top").rowsBetween(Window.unboundedPreceding, -1)
    # A row per subtree, of which a tree has few.
    begins = subtrees.groupBy("tree", "top").agg(F.count(F.lit(1)).alias("_n")).join(sizes, "tree")
    begins = begins.select("tree", "top", (F.col("size") + F.coalesce(F.sum(F.col("_n") - 1).over(before), F.lit(0))).alias("_first"))
    moved = {c: (F.col("_first") + F.col(c) - 1).cast("int") for c in ("id", "left")}
    moved = {"id": F.when(F.col("id") == 0, F.col("top")).otherwise(moved["id"]), "left": F.when(F.col("left") < 0, -1).otherwise(moved["left"])}
    below = subtrees.join(F.broadcast(begins), ["tree", "top"]).withColumns(moved)
    return below.select(*FOREST.names).unionAll(spark.createDataFrame(upper, FOREST_SCHEMA))


class ForestModel(Model, MLWritable, MLReadable):
    """A fitted forest: a stored table of nodes ``(tree, id, left, feature, threshold, share, won)``.

    A node's second child follows its first. ``share`` is the weighted share of label 1, and ``won`` what a split adds to
    the purity of all rows. Up to ``NODES_AT_ONCE`` nodes go to every task as arrays of 20 bytes a node. Of a larger
    forest the driver sees the trees' sizes only: rows and trees meet by a shuffle, a part of the rows and some whole
    trees in a task. A tree beyond ``MOST_NODES`` is refused, and so is a forest beyond it on a stream.
    """

    MOST_NODES = 50_000_000
    NODES_AT_ONCE = 1_000_000
    ROWS_AT_ONCE = 250_000

    def __init__(self, nodes: DataFrame, trees: int):
        super().__init__()
        self.nodes, self.getNumTrees, self._shared, self._counted = nodes, trees, None, None

    def importances(self) -> DataFrame:
        """``(slot, importance)`` of the vector's slots that any tree splits by; each tree counts alike."""
        won = self.nodes.where("left >= 0").groupBy("tree", F.col("feature").alias("slot")).agg(F.sum("won").alias("won"))
        trees = won.groupBy("tree").agg(F.sum("won").alias("all"))  # a row per tree
        parts = won.join(F.broadcast(trees), "tree").where("all > 0")
        summed = parts.groupBy("slot").agg(F.sum(F.col("won") / F.col("all")).alias("part"))
        total = summed.agg(F.sum("part").alias("total"))
        return summed.crossJoin(F.broadcast(total)).select("slot", (F.col("part") / F.col("total")).alias("importance"))

    def _sizes(self) -> dict[int, int]:
        """Number of nodes of each tree."""
        if self._counted is None:
            self._counted = {r["tree"]: r["count"] for r in self.nodes.groupBy("tree").count().collect()}
        return self._counted

    def _packed(self):
        """All nodes as :func:`_arrays` has them."""
        if self._shared is None:
            self._shared = self.nodes.sparkSession.sparkContext.broadcast(_arrays(self.nodes.selectExpr(*NODE_COLUMNS).toArrow()))
        return self._shared

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes = self._sizes().values()
        count = sum(sizes) if dataset.isStreaming else max(sizes, default=0)
        if count > self.MOST_NODES:
            raise ValueError(f"{count} nodes are too large for a task")
        if sum(sizes) > self.NODES_AT_ONCE and not dataset.isStreaming:
            return self._met(dataset)
        shared = self._packed()

        @arrow_udf("double")
        def share(features: pa.Array) -> pa.Array:
            return pa.array(_shares(features, *shared.value))

        return with_probability(dataset, share("features"))

    def _met(self, dataset: DataFrame) -> DataFrame:
        """Scores by a shuffle: each group of trees adds up the shares of each part of the rows."""
        # Written once, for rows are told apart by a number; what the columns' metadata lists stays out of the files.
        told = {c: dataset.schema[c].metadata for c in dataset.columns}
        bare = dataset.select(*[F.col(f"`{c}`").alias(c, metadata={}) for c in told], F.monotonically_increasing_id().alias("_row"))
        stored = materialize(bare, "to-score")
        trees = self.getNumTrees
        groups = min(trees, -(-sum(self._sizes().values()) // self.NODES_AT_ONCE))
        parts = max(1, -(-stored.count() // self.ROWS_AT_ONCE))
        every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name) for n, name in ((groups, "_group"), (parts, "_part"))]
        rows = stored.select("_row", "features", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int").alias("_part"), every[0])
        nodes = self.nodes.selectExpr(*NODE_COLUMNS).select("*", (F.col("tree") % groups).alias("_group"), every[1])

        def add_up(rows: pa.Table, nodes: pa.Table) -> pa.Table:
            packed = _arrays(nodes)
            shares = _shares(rows.column("features").combine_chunks(), *packed) * len(packed[0])
            return pa.table({"_row": rows.column("_row"), "_shares": pa.array(shares)})

        sums = rows.groupBy("_group", "_part").cogroup(nodes.groupBy("_group", "_part")).applyInArrow(add_up, "_row long, _shares double")
        # Added in the order of their size, so that scores do not depend on what arrives first.
        total = F.aggregate(F.array_sort(F.collect_list("_shares")), F.lit(0.0), lambda a, b: a + b)
        scored = stored.join(sums.groupBy("_row").agg((total / trees).alias("_share")), "_row")
        known = [F.col(f"`{c}`").alias(c, metadata=metadata) for c, metadata in told.items()]
        return with_probability(scored.select(*known, "_share"), F.col("_share")).drop("_share")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"trees": self.model.getNumTrees})
        self.model.nodes.write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return ForestModel(self.sparkSession.read.parquet(f"{path}/nodes"), metadata["trees"])


# What scoring reads of a node.
NODE_COLUMNS = ["tree", "id", "left", "feature", "threshold", "cast(share AS float) AS share"]


def _arrays(nodes: pa.Table) -> tuple[np.ndarray, ...]:
    """Where each tree begins, the slots that are split by, and children, features, thresholds and shares of all nodes in a row."""
    tree, at, left, feature, threshold, share = (nodes.column(c).to_numpy() for c in ("tree", "id", "left", "feature", "threshold", "share"))
    tree = np.unique(tree, return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(np.bincount(tree))])
    place = starts[tree] + at
    packed = [np.empty(len(at), x.dtype) for x in (left, feature, threshold, share)]
    for to, x in zip(packed, (np.where(left < 0, -1, left + starts[tree]).astype(np.int32), feature, threshold, share)):
        to[place] = x
    used = np.unique(packed[1][packed[1] >= 0])
    packed[1] = np.searchsorted(used, packed[1]).astype(np.int32)
    return starts[:-1].astype(np.int32), used, *packed


STEPS_AT_ONCE = 2_000_000  # rows times trees, and rows times features


def _shares(features: pa.Array, starts, used, left, feature, threshold, share) -> np.ndarray:
    """Mean share of label 1 in the leaves that each vector ends in."""
    out, size = np.empty(len(features)), max(1, STEPS_AT_ONCE // max(len(starts), len(used), 1))
    for at in range(0, len(features), size):
        value = _dense(features[at : at + size], used)
        rows = np.arange(len(value))
        node = np.tile(starts, len(rows))
        row = np.repeat(rows, len(starts))
        going = np.flatnonzero(left[node] >= 0)
        while len(going):
            here = node[going]
            node[going] = left[here] + (value[row[going], feature[here]] > threshold[here])
            going = going[left[node[going]] >= 0]
        out[at : at + size] = share[node].reshape(len(rows), -1).mean(1, dtype=float)
    return out


def _dense(features: pa.Array, used: np.ndarray) -> np.ndarray:
    """The slots ``used`` of vectors given as structs of type, size, indices and values."""
    row, slot, value = vector_entries(features)
    place = np.searchsorted(used, slot)
    known = place < len(used)
    known[known] = used[place[known]] == slot[known]
    out = np.zeros((len(features), len(used)))
    out[row[known], place[known]] = value[known]
    return out


def vector_entries(features: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of all that vectors hold; sparse and dense ones may be mixed."""
    kind, _, indices, values = features.flatten()  # which, unlike field(), heeds a slice
    sizes = np.diff(values.offsets.to_numpy())
    dense = kind.to_numpy(zero_copy_only=False) == 1
    row = np.repeat(np.arange(len(features)), sizes)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    slot[~dense[row]] = indices.flatten().to_numpy()
    return row, slot, values.flatten().to_numpy()


class Boosting(_Bounded):
    """Boosted trees for the logistic loss on a bounded number of rows, or all; fits a ``GBTClassificationModel``."""

    @keyword_only
    def __init__(
        self, *, rounds: int, rate: float, growth: Growth, row_share: float = 1.0, column_share: float = 1.0,
        most_bins: int = 256, from_prior: bool = True, rows_to_fit: int | None = ROWS_TO_FIT, seed: int = 42,
    ):
        super().__init__()
        self.rounds, self.rate, self.growth, self.row_share, self.column_share = rounds, rate, growth, row_share, column_share
        self.most_bins, self.from_prior, self.rows_to_fit, self.seed = most_bins, from_prior, rows_to_fit, seed
        self.depth = growth.depth

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        count = dataset.where(F.col(self.label).isNotNull()).count() if self.rows_to_fit is None else None
        if count == 0:
            raise ValueError("no labelled rows to fit boosted trees on")
        if count is not None and count > BOOSTED_ROWS_TO_A_TASK:
            rows = self._labelled(dataset).withColumn("place", F.xxhash64("features"))
            bins = fit_bins(rows, _width(dataset), self.most_bins)
            how = (self.rounds, self.rate, self.row_share, self.column_share, self.growth, self.from_prior, self.seed)
            grown = _table(boost_all(rows, bins, *how))  # of a size that rounds and growth bound, not the rows
            return GBTClassificationModel.load(self._stored(dataset.sparkSession.createDataFrame(grown), dataset))
        how = (self.rounds, self.rate, self.row_share, self.column_share, self.growth, self.most_bins, self.from_prior, self.seed)
        handed = self._handed_over(dataset, 1)
        nodes = handed.groupBy("group").applyInArrow(lambda table: _table(boost(Rows.read(table), *how)), NODE_SCHEMA)
        return GBTClassificationModel.load(self._stored(nodes, dataset))

    def _stored(self, nodes: DataFrame, dataset: DataFrame) -> str:
        """Where the model of these nodes stands, in the format of Spark ML."""
        spark, path = dataset.sparkSession, new_path(dataset.sparkSession, "trees")
        # What a leaf lacks is -1, and its threshold no number. Columns of zeros and ones are numbers here.
        threshold = F.when(F.col("left") < 0, F.array().cast("array<double>")).otherwise(F.array("threshold"))
        split = F.struct(
            F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")
        )
        data = F.struct(
            "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
            F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
        )
        nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")
        params = {"maxDepth": self.growth.depth or 30, "impurity": "variance"}
        told = {"featuresCol": "features", "labelCol": self.label, "maxIter": self.rounds, "stepSize": self.rate}

        def described(name: str, uid: str, params: dict, **more) -> str:
            head = {"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
            return json.dumps(head | {"uid": uid, "paramMap": params, "defaultParamMap": {}} | more)

        counts = {"numFeatures": _width(dataset), "numTrees": self.rounds}
        head = described("classification.GBTClassificationModel", self.uid, params | told, **counts)
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        tree = described("regression.DecisionTreeRegressionModel", f"{self.uid}_tree", params)
        trees = spark.range(self.rounds).selectExpr("cast(id as int) AS _1")
        trees.select("_1", F.lit(tree).alias("_2"), F.lit(1.0).alias("_3")).write.parquet(f"{path}/treesMetadata")
        return path
