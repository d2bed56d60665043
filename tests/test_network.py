"""The network: gradients, batches, stopping, and its model."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from furrow.operators import network
from furrow.operators.network import Network


def some_data(n=400, seed=0):
    random = np.random.default_rng(seed)
    x = random.normal(0, 1, (n, 4))
    return x, ((x[:, 0] * x[:, 1] > 0) ^ (random.random(n) < 0.05)).astype(float)


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(4)
    x, y = some_data(13)
    weights = [(w, random.normal(0, 0.3, len(o))) for w, o in network.fresh_weights(4, (6, 5, 3), random)]
    masks = [(random.random((13, n)) < 0.8) / 0.8 for n in (6, 5, 3)]
    _, found = network.gradients(weights, x, y, masks)
    for pair, grads in zip(weights, found):
        for p, g in zip(pair, grads):
            for at in np.ndindex(p.shape):
                keep, sides = p[at], []
                for step in (1e-6, -1e-6):
                    p[at] = keep + step
                    sides.append(network.gradients(weights, x, y, masks)[0])
                p[at] = keep
                assert (sides[0] - sides[1]) / 2e-6 == pytest.approx(g[at], abs=1e-6)


def test_without_dropout_the_loss_is_that_of_scoring():
    x, y = some_data(50)
    weights = network.fresh_weights(4, (6, 3), np.random.default_rng(1))
    whole = [np.ones((50, n)) for n in (6, 3)]
    assert network.gradients(weights, x, y, whole)[0] == pytest.approx(network.mean_loss(network.margins(weights, x), y))


def test_it_learns_what_no_line_parts():
    x, y = some_data(2000)
    weights, curve = network.train(x[200:], y[200:], (x[:200], y[:200]), (64, 32, 16), 0.2, 30, 32, 10, 1)
    assert ((network.margins(weights, x[:200]) > 0) == y[:200]).mean() > 0.85
    assert curve[0][0] > min(a for a, _ in curve)
    assert network.mean_loss(network.margins(weights, x[:200]), y[:200]) == pytest.approx(min(b for _, b in curve))


def test_it_stops_early_and_keeps_the_best_weights():
    x, y = some_data(60)
    wrong = x, 1 - y  # what is learned only harms here
    weights, curve = network.train(x, y, wrong, (64, 32, 16), 0.0, 200, 8, 3, 2)
    losses = [b for _, b in curve]
    best = int(np.argmin(losses))
    assert len(curve) == best + 1 + 3 < 200
    assert network.mean_loss(network.margins(weights, x), 1 - y) == pytest.approx(losses[best])


@pytest.fixture(scope="module")
def table(spark):
    x, y = some_data(300)
    rows = [(int(b), Vectors.dense(a) if i % 2 else Vectors.sparse(4, list(enumerate(a)))) for i, (a, b) in enumerate(zip(x.tolist(), y))]
    described = F.col("features").alias("features", metadata={"ml_attr": {"num_attrs": 4}})
    return spark.createDataFrame(rows, ["result", "features"]).select(F.col("result").cast("int").alias("result"), described), x


def test_model_round_trip(table, path):
    df, x = table
    model = Network(passes=4, seed=5).fit(df)
    assert len(model.curve) == 4 and 1 <= model.best_pass <= 4 and model.layers == (64, 32, 16)
    scored = model.transform(df)
    got = [r[0][1] for r in scored.select(vector_to_array("probability")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-network.margins(model.weights(), x))))
    assert Network(passes=4, seed=5).fit(df.repartition(3)).blob == model.blob
    PipelineModel(stages=[model]).write().save(path("m"))
    again = PipelineModel.load(path("m"))
    assert again.transform(df).select("prediction", "probability").collect() == scored.select("prediction", "probability").collect()
    assert again.stages[0].curve == model.curve
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="no labelled rows"):
        Network().fit(df.limit(0))
