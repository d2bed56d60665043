"""Tree learners against plain versions, and their models."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.compute as pc
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators import trees
from furrow.operators.trees import Boosting, Forest, ForestModel, Growth, Rows


class Halfway:
    """In place of a random generator: every draw is a half, and all features are tried."""

    def random(self, n):
        return np.full(n, 0.5)

    def hypergeometric(self, good, bad, wanted):
        return good


def some_rows(n=120, seed=3, slots=5):
    """Two number columns and ones in ``slots`` columns, with labels that depend on all of them."""
    random = np.random.default_rng(seed)
    numbers = np.stack([random.integers(0, 12, n) * 1.5, random.normal(0, 3, n).round(1)])
    hot = random.integers(0, slots, n)
    label = ((numbers[0] > 6) ^ (hot == 2) ^ (random.random(n) < 0.2)).astype(np.int64)
    return Rows(label, random.choice([1.0, 1.5], n), slots + 2, numbers, np.array([slots, slots + 1]), np.arange(n), hot)


def matrix(rows):
    out = np.zeros((len(rows.label), rows.width))
    out[rows.hot_row, rows.hot_slot] = 1
    out[:, rows.number_of] = rows.numbers.T
    return out


def purity(label, weight):
    return sum(weight[label == c].sum() ** 2 for c in (0, 1)) / weight.sum() if len(label) else 0.0


def plain_tree(x, y, w, cuts_of):
    """Nested ``(feature, cut, left, right)``, or the weighted share of label 1."""
    found = []
    if len(set(y)) > 1:
        for f in range(x.shape[1]):
            for cut in cuts_of(np.unique(x[:, f])):
                right = x[:, f] > cut
                found.append((purity(y[~right], w[~right]) + purity(y[right], w[right]), f, cut))
    if not found:
        return w[y == 1].sum() / w.sum()
    best = max(score for score, _, _ in found)
    return best, [(f, cut) for score, f, cut in found if math.isclose(score, best, rel_tol=1e-12)]


def nodes_of(table):
    return {r["id"]: r for r in table.to_pylist()}


def follow(nodes, x, y, w, cuts_of, at=0):
    """Every split of a grown tree is one of the best that the plain version finds; returns the number of leaves."""
    node, want = nodes[at], plain_tree(x, y, w, cuts_of)
    assert node["share"] == pytest.approx(w[y == 1].sum() / w.sum())
    if not isinstance(want, tuple):
        assert node["left"] == -1
        return 1
    best, splits = want
    assert any(f == node["feature"] and math.isclose(cut, node["threshold"], abs_tol=1e-9) for f, cut in splits)
    assert node["won"] == pytest.approx(best - purity(y, w), abs=1e-9)
    right = x[:, node["feature"]] > node["threshold"]
    return sum(follow(nodes, x[side], y[side], w[side], cuts_of, node["left"] + i) for i, side in enumerate((~right, right)))


def middles(values):
    return (values[1:] + values[:-1]) / 2


def halfway(values):
    """The one cut that a draw of a half gives; columns of ones are cut at a half anyway."""
    return [(values[0] + values[-1]) / 2] if len(values) > 1 else []


@pytest.mark.parametrize("random_cuts, cuts_of", [(False, middles), (True, halfway)])
def test_trees_split_like_plain_ones(monkeypatch, random_cuts, cuts_of):
    for cells in (trees.MOST_CELLS, 0):
        monkeypatch.setattr(trees, "MOST_CELLS", cells)
        rows = some_rows()
        table = trees.grow_tree(rows, 0, Halfway(), False, random_cuts, rows.width)
        assert follow(nodes_of(table), matrix(rows), rows.label, rows.weight, cuts_of) > 10


def test_forests_are_fully_grown_and_repeatable():
    rows = some_rows(400)
    for bootstrap, random_cuts in ((True, False), (False, True)):
        one, two = (trees.grow_tree(rows, 1, np.random.default_rng(5), bootstrap, random_cuts, 2) for _ in range(2))
        assert one.equals(two)
        leaves = one.filter(pc.equal(one["left"], -1))["share"].to_numpy()
        # Rows that agree in all features may differ in label.
        assert np.isin(leaves, (0.0, 1.0)).mean() > 0.9
        assert one.num_rows == 2 * len(leaves) - 1


def test_depth_is_not_bounded():
    n = 300
    rows = Rows(np.arange(n) % 2, np.ones(n), 1, np.arange(n, dtype=float)[None], np.array([0]), np.empty(0, int), np.empty(0, int))
    table = trees.grow_tree(rows, 0, np.random.default_rng(0), False, False, 1)
    assert (table["left"].to_numpy() == -1).sum() == n


# Boosting


def plain_boosted(x, g, h, growth):
    """Leaves ``(rows, value)`` by splitting the leaf of largest gain first."""

    def value(rows):
        return -g[rows].sum() / (h[rows].sum() + growth.l2 + 1e-12)

    def part(rows):
        below = len(rows) if growth.by_residuals else h[rows].sum()
        return g[rows].sum() ** 2 / (below + growth.l2 + 1e-12)

    def best(rows):
        found = []
        for f in range(x.shape[1]):
            for cut in middles(np.unique(x[:, f])):
                sides = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(map(len, sides)) >= growth.least_rows and min(h[s].sum() for s in sides) >= growth.least_hessian and all(map(len, sides)):
                    found.append((sum(map(part, sides)) - part(rows), sides))
        return max(found, key=lambda c: c[0], default=(0, None))

    everything = np.arange(len(g))
    leaves = [(everything, (*best(everything), 0))]
    while growth.leaves is None or len(leaves) < growth.leaves:
        able = [(c[0], i) for i, (_, c) in enumerate(leaves) if c[0] > 1e-10 and (growth.depth is None or c[2] < growth.depth)]
        if not able:
            break
        _, i = max(able)
        _, (_, sides, depth) = leaves.pop(i)
        leaves += [(s, (*best(s), depth + 1)) for s in sides]
    return [(rows, value(rows)) for rows, _ in leaves]


@pytest.mark.parametrize(
    "growth",
    [
        Growth(depth=3, l2=1.0, least_hessian=1.0),
        Growth(leaves=5, least_rows=10),
        Growth(depth=2, by_residuals=True),
        Growth(depth=4, leaves=6, l2=0.5),
    ],
)
def test_boosted_leaves_like_plain_ones(growth):
    rows = some_rows(150, seed=8)
    x, y = matrix(rows), rows.label.astype(float)
    got = trees.boost(rows, 4, 0.3, 1.0, 1.0, growth, 256, True, 1)
    start = math.log(y.mean() / (1 - y.mean()))
    margin, model = np.full(len(y), start), np.zeros(len(y))
    for nodes in got:
        p = 1 / (1 + np.exp(-margin))
        for members, value in plain_boosted(x, p - y, p * (1 - p), growth):
            margin[members] += 0.3 * value
        model += 2 * boosted_values(nodes, x)
        assert np.allclose(model, margin)


def boosted_values(nodes, x):
    out = np.zeros(len(x))
    for i, row in enumerate(x):
        at = 0
        while nodes.rows[at][7] >= 0:
            at = nodes.rows[at][8 if row[nodes.rows[at][9]] > nodes.rows[at][10] else 7]
        out[i] = nodes.rows[at][2]
    return out


def test_few_bins_and_shares():
    rows = some_rows(500, seed=2)
    got = trees.boost(rows, 30, 0.2, 0.7, 0.5, Growth(depth=3), 8, True, 1)
    again = trees.boost(rows, 30, 0.2, 0.7, 0.5, Growth(depth=3), 8, True, 1)
    assert [n.rows for n in got] == [n.rows for n in again]
    margin = 2 * sum(boosted_values(nodes, matrix(rows)) for nodes in got)
    assert ((margin > 0) == rows.label).mean() > 0.75
    # A tree sees half of the seven features.
    assert all(len({row[9] for row in nodes.rows if row[7] >= 0}) <= 4 for nodes in got)


# Tables


@pytest.fixture(scope="module")
def table(spark):
    rows = some_rows(600, seed=1)
    x = matrix(rows)
    sparse = [Vectors.sparse(7, [(i, v) for i, v in enumerate(r) if v]) if k % 3 else Vectors.dense(r) for k, r in enumerate(x.tolist())]
    made = spark.createDataFrame([(int(y), float(w), v) for y, w, v in zip(rows.label, rows.weight, sparse)], ["result", "weight", "features"])
    described = F.col("features").alias("features", metadata={"ml_attr": {"num_attrs": 7}})
    return made.select(F.col("result").cast("int").alias("result"), "weight", described), rows


def test_rows_are_read_from_vectors_of_both_kinds(table):
    df, rows = table
    read = Rows.read(df.select(F.col("result").alias("label"), "weight", "features", F.monotonically_increasing_id().alias("place")).toArrow())
    assert read.width == 7 and (matrix(read) == matrix(rows)).all()
    assert (read.label == rows.label).all() and (read.weight == rows.weight).all()


def test_a_forest_scores_like_its_nodes_and_is_kept(table, path):
    df, rows = table
    model = Forest(trees=11, seed=3).fit(df)
    assert isinstance(model, ForestModel) and model.getNumTrees == 11
    got = model.transform(df).select(vector_to_array("probability").alias("p"), "prediction").collect()
    by_tree = {}
    for r in model.nodes.collect():
        by_tree.setdefault(r["tree"], {})[r["id"]] = r
    x, want = matrix(rows), []
    for row in x:
        shares = []
        for nodes in by_tree.values():
            at = 0
            while nodes[at]["left"] >= 0:
                at = nodes[at]["left"] + int(row[nodes[at]["feature"]] > nodes[at]["threshold"])
            shares.append(nodes[at]["share"])
        want.append(sum(shares) / len(shares))
    assert np.allclose([r["p"][1] for r in got], want, atol=1e-6)
    assert all(r["prediction"] == (r["p"][1] > 0.5) for r in got)
    importances = {r["slot"]: r["importance"] for r in model.importances().collect()}
    wanted = np.zeros(7)
    for nodes in by_tree.values():
        won = np.zeros(7)
        for r in nodes.values():
            if r["left"] >= 0:
                won[r["feature"]] += r["won"]
        wanted += won / won.sum() / len(by_tree)
    assert {f: importances.get(f, 0.0) for f in range(7)} == pytest.approx(dict(enumerate(wanted)))
    PipelineModel(stages=[model]).write().save(path("m"))
    again = PipelineModel.load(path("m"))
    assert again.transform(df).select("probability").collect() == model.transform(df).select("probability").collect()
    assert model.transform(df.limit(0)).count() == 0


def test_a_boosted_model_is_one_of_spark(table):
    df, rows = table
    model = Boosting(rounds=7, rate=0.3, growth=Growth(depth=3, l2=1.0)).fit(df)
    assert type(model).__name__ == "GBTClassificationModel" and model.getNumTrees == 7
    read = Rows.read(df.select(F.col("result").alias("label"), F.lit(1.0).alias("weight"), "features", F.xxhash64("features").alias("place")).toArrow())
    grown = trees.boost(read, 7, 0.3, 1.0, 1.0, Growth(depth=3, l2=1.0), 256, True, 42)
    margin = 2 * sum(boosted_values(nodes, matrix(rows)) for nodes in grown)
    got = [r[0][1] for r in model.transform(df).select(vector_to_array("probability")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-margin)))


def test_the_bound_on_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 4 == 0).cast("int").alias("result"), F.col("id"))
    taken = trees.sample_rows(rows, 2_000, 1)
    count, ones = taken.agg(F.count(F.lit(1)), F.avg("result")).first()
    assert abs(count - 2_000) < 200 and abs(ones - 0.25) < 0.04
    assert trees.sample_rows(rows, 20_000, 1).count() == 20_000
    copies = spark.range(3_000).select(F.lit(1).alias("result"), F.lit(7).alias("x"))  # copies of one row are rows
    assert abs(trees.sample_rows(copies, 1_000, 1).count() - 1_000) < 150


def test_a_forest_too_large_to_send_is_refused(table, monkeypatch):
    model = Forest(trees=2).fit(table[0])
    monkeypatch.setattr(ForestModel, "MOST_NODES", 5)
    with pytest.raises(ValueError, match="too large"):
        model.transform(table[0])


def test_a_large_forest_meets_its_rows_without_the_driver(table, monkeypatch):
    """Same scores and columns by the shuffle, whose driver sees a row per tree and no node."""
    df, rows = table
    df = df.withColumn("key", F.monotonically_increasing_id())
    model = Forest(trees=11, seed=3).fit(df)
    want = model.transform(df)
    monkeypatch.setattr(ForestModel, "NODES_AT_ONCE", 300)
    monkeypatch.setattr(ForestModel, "ROWS_AT_ONCE", 150)
    monkeypatch.setattr(ForestModel, "_packed", lambda self: pytest.fail("the nodes went to the driver"))
    got = model.transform(df)
    assert got.columns == want.columns and got.schema["features"].metadata == df.schema["features"].metadata
    read = lambda t: sorted((r["key"], r["p"][1], r["prediction"]) for r in t.select("key", vector_to_array("probability").alias("p"), "prediction").collect())
    assert np.allclose(read(got), read(want), atol=1e-12) and len(read(got)) == 600
    twice = df.union(df)
    assert model.transform(twice).count() == 1200 and model.transform(df.limit(0)).count() == 0


# All rows


@pytest.mark.parametrize(
    "how",
    [
        {"growth": Growth(depth=3, l2=1.0, least_hessian=1.0)},
        {"growth": Growth(leaves=6, least_rows=10), "from_prior": False},
        {"growth": Growth(depth=2, by_residuals=True)},
        {"growth": Growth(depth=4, leaves=6, l2=0.5), "column_share": 0.6},
    ],
)
def test_boosting_on_all_rows_is_that_of_one_task(table, monkeypatch, how):
    """Twenty-odd blocks, whose sums meet, give the trees of one task that has all rows; nothing is sampled."""
    df, _ = table
    want = Boosting(rounds=4, rate=0.3, **how).fit(df)
    monkeypatch.setattr(trees, "ROWS_TO_A_BLOCK", 50)
    monkeypatch.setattr(trees, "ROUNDS_KEPT", 2)
    monkeypatch.setattr(DataFrame, "sample", lambda *a, **k: pytest.fail("sampled"))
    got = Boosting(rounds=4, rate=0.3, rows_to_fit=None, **how).fit(df)
    p = [[r[0][1] for r in m.transform(df).select(vector_to_array("probability")).collect()] for m in (got, want)]
    assert np.allclose(*p) and got.getNumTrees == 4


def test_boosting_on_all_rows_draws_shares(table, monkeypatch):
    df, rows = table
    monkeypatch.setattr(trees, "ROWS_TO_A_BLOCK", 100)
    fits = [Boosting(rounds=12, rate=0.3, rows_to_fit=None, row_share=0.7, most_bins=8, growth=Growth(depth=3)).fit(df) for _ in range(2)]
    p = [[r[0][1] for r in m.transform(df).select(vector_to_array("probability")).collect()] for m in fits]
    assert p[0] == p[1] and ((np.array(p[0]) > 0.5) == rows.label).mean() > 0.75


def wins(nodes, x, y, w, at=0):
    """As :func:`follow`, but for where between two of a node's values a cut stands."""
    node, want = nodes[at], plain_tree(x, y, w, middles)
    assert node["share"] == pytest.approx(w[y == 1].sum() / w.sum())
    if not isinstance(want, tuple):
        assert node["left"] == -1
        return 1
    assert node["won"] == pytest.approx(want[0] - purity(y, w), abs=1e-9)
    right = x[:, node["feature"]] > node["threshold"]
    return sum(wins(nodes, x[side], y[side], w[side], node["left"] + i) for i, side in enumerate((~right, right)))


@pytest.mark.parametrize("random_cuts", [False, True])
def test_a_forest_on_more_rows_than_a_task_takes(table, monkeypatch, random_cuts):
    """Upper nodes by passes over the rows, subtrees in tasks: whole trees of one numbering, which every row has part in."""
    df, rows = table
    monkeypatch.setattr(trees, "ROWS_TO_A_TASK", 100)
    monkeypatch.setattr(trees, "ROWS_TO_A_BLOCK", 150)
    monkeypatch.setattr(trees, "ROWS_HANDED_OVER", 1_300)
    model = Forest(trees=3, bootstrap=False, random_cuts=random_cuts, per_node=7, rows_to_fit=None).fit(df)
    x = matrix(rows)
    for tree in range(3):
        nodes = {r["id"]: r.asDict() for r in model.nodes.where(F.col("tree") == tree).collect()}
        assert sorted(nodes) == list(range(len(nodes))) and len(nodes) > 100
        if not random_cuts:
            assert wins(nodes, x, rows.label, rows.weight) > 50
    # The leaves have the labels of the rows in them, but for rows that agree in all features.
    got = [r["prediction"] for r in model.transform(df).collect()]
    assert (np.array(got) == rows.label).mean() > 0.97


def test_a_drawn_forest_on_more_rows_than_a_task_takes(table, monkeypatch):
    df, rows = table
    monkeypatch.setattr(trees, "ROWS_TO_A_TASK", 100)
    one, two = (Forest(trees=5, rows_to_fit=None).fit(df) for _ in range(2))
    assert sorted(map(tuple, one.nodes.collect())) == sorted(map(tuple, two.nodes.collect()))
    assert (np.array([r["prediction"] for r in one.transform(df).collect()]) == rows.label).mean() > 0.8
    place = np.arange(100_000)
    counts = np.bincount(trees.drawn(place, 1, 42), minlength=4)[:4] / 100_000
    assert np.allclose(counts, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.006)
    assert (trees.drawn(place, 2, 42) != trees.drawn(place, 1, 42)).mean() > 0.5


def test_boosting_rows_that_a_task_takes_needs_no_job_a_level(table, monkeypatch):
    """All of them are used, in one task and one pass; beyond that the rows stay where they are."""
    df, rows = table
    growth, passes, keep = Growth(depth=3, l2=1.0), [], trees.boost_all
    monkeypatch.setattr(trees, "boost_all", lambda *a: passes.append(1) or keep(*a))
    models = {}
    for most in (600, 599):
        monkeypatch.setattr(trees, "BOOSTED_ROWS_TO_A_TASK", most)
        models[most] = Boosting(rounds=5, rate=0.3, rows_to_fit=None, row_share=0.9 if most == 600 else 1.0, growth=growth).fit(df)
        assert len(passes) == (most == 599)
        got = models[most].transform(df).select("prediction").collect()
        assert (np.array([r[0] for r in got]) == rows.label).mean() > 0.75
    with pytest.raises(ValueError, match="no labelled rows"):
        Boosting(rounds=2, rate=0.3, rows_to_fit=None, growth=growth).fit(df.limit(0))


def test_boosted_sums_and_rows_left_out():
    """Sums by bin are those of a plain loop, and rows that a tree does not take get the value of their leaf."""
    rows = some_rows(300, seed=4)
    bins, random = trees.Bins.of(rows, 256), np.random.default_rng(0)
    own, value = np.flatnonzero(random.random(300) < 0.6), random.normal(size=300)
    codes, want = bins.coded(rows), np.zeros((2, bins.size))
    for i in own:
        for code in codes[i]:
            want[:, code] += value[i], 1
    assert np.allclose(bins.sums(own, value, None, value), want[[0, 1, 0]])
    for growth in (Growth(depth=3, l2=1.0), Growth(leaves=6), Growth(depth=2, by_residuals=True)):
        nodes = trees._Nodes(0)
        everyone = np.ones(bins.size, bool)
        got = trees.boosted_tree(bins, value, np.full(300, 0.2), own, everyone, growth, nodes)
        assert np.allclose(got, boosted_values(nodes, matrix(rows)))
        assert nodes.rows[0][5] == len(own) and sum(r[5] for r in nodes.rows if r[7] < 0) == len(own)


def test_groups_of_trees_do_not_share_a_task(table, monkeypatch):
    """A task for each group of trees, in which how many are together changes nothing of them."""
    df, _ = table
    forests, parts = [], []
    for most in (8, 32):
        monkeypatch.setattr(trees, "MOST_TREES_TO_A_TASK", most)
        monkeypatch.setattr(trees, "TASKS_TO_A_THREAD", 1)
        forest = Forest(trees=100, seed=3, rows_to_fit=None)
        forests.append(sorted(map(tuple, forest.fit(df).nodes.collect())))
        dealt = forest._handed_over(df, 7).select("group", F.spark_partition_id().alias("part")).distinct().collect()
        parts.append(sorted(r["part"] for r in dealt))
    assert forests[0] == forests[1] and parts == [[*range(7)]] * 2


@pytest.mark.parametrize("growth", [Growth(leaves=6, least_rows=10), Growth(depth=4, leaves=6, l2=0.5), Growth(depth=3, l2=1.0)])
def test_boosting_more_rows_than_a_task_takes_is_that_of_one_task(table, monkeypatch, growth):
    """Leaf-wise and level-wise trees are the same on either side of the bound, and the roots count every row."""
    df, _ = table
    p = []
    for most in (600, 100):
        monkeypatch.setattr(trees, "BOOSTED_ROWS_TO_A_TASK", most)
        monkeypatch.setattr(trees, "ROWS_TO_A_BLOCK", 50)
        model = Boosting(rounds=4, rate=0.3, rows_to_fit=None, growth=growth).fit(df)
        p.append([r[0][1] for r in model.transform(df).select(vector_to_array("probability")).collect()])
    assert np.allclose(*p)
