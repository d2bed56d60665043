"""A feed-forward network for two classes: ReLU layers with dropout, small batches with Adam, and early stopping."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from furrow.operators.trees import ROWS_TO_FIT, sample_rows, vector_entries, with_probability
from furrow.schemas import LABEL

LAYERS = (64, 32, 16)
# Adam's usual constants.
STEP, MEAN_DECAY, SQUARE_DECAY, TINY = 0.001, 0.9, 0.999, 1e-7
CURVE_SCHEMA = "pass int, loss double, monitored double, weights binary"
CURVE = pa.schema([("pass", pa.int32()), ("loss", pa.float64()), ("monitored", pa.float64()), ("weights", pa.binary())])

Weights = list[tuple[np.ndarray, np.ndarray]]


def dense(features: pa.Array, width: int) -> np.ndarray:
    """Vectors, as structs of type, size, indices and values, as rows of a matrix."""
    row, slot, value = vector_entries(features)
    out = np.zeros((len(features), width))
    out[row, slot] = value
    return out


def fresh_weights(width: int, layers: tuple[int, ...], random: np.random.Generator) -> Weights:
    """Evenly drawn weights, in a range that keeps the spread from layer to layer, and no offsets."""
    sizes = [width, *layers, 1]
    spans = [math.sqrt(6 / (a + b)) for a, b in zip(sizes, sizes[1:])]
    return [(random.uniform(-s, s, (a, b)), np.zeros(b)) for a, b, s in zip(sizes, sizes[1:], spans)]


def margins(weights: Weights, x: np.ndarray) -> np.ndarray:
    for w, offset in weights[:-1]:
        x = np.maximum(x @ w + offset, 0)
    return (x @ weights[-1][0] + weights[-1][1])[:, 0]


def mean_loss(margin: np.ndarray, y: np.ndarray) -> float:
    """Binary cross-entropy of log odds."""
    return float(np.logaddexp(0, np.where(y > 0, -margin, margin)).mean()) if len(y) else 0.0


def gradients(weights: Weights, x: np.ndarray, y: np.ndarray, masks: list[np.ndarray]) -> tuple[float, Weights]:
    """Mean loss of a batch and its gradients; ``masks`` scale the units of each hidden layer (0: dropped)."""
    inputs, kept = [x], []
    for (w, offset), mask in zip(weights[:-1], masks):
        sums = inputs[-1] @ w + offset
        kept.append((sums > 0) * mask)
        inputs.append(sums * kept[-1])
    margin = (inputs[-1] @ weights[-1][0] + weights[-1][1])[:, 0]
    back = ((1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y) / len(y))[:, None]
    out = []
    for at in range(len(weights) - 1, -1, -1):
        out.append((inputs[at].T @ back, back.sum(0)))
        if at:
            back = (back @ weights[at][0].T) * kept[at - 1]
    return mean_loss(margin, y), out[::-1]


def train(
    x: np.ndarray, y: np.ndarray, watched: tuple[np.ndarray, np.ndarray], layers: tuple[int, ...], dropout: float, passes: int,
    batch: int, patience: int, seed: int,
) -> tuple[Weights, list[tuple[float, float]]]:
    """The weights after the pass of least loss on the ``watched`` rows, and both losses of every pass.

    Training ends after ``passes``, or when ``patience`` passes in a row were no better.
    """
    random = np.random.default_rng(seed)
    weights = fresh_weights(x.shape[1], layers, random)
    flat = [p for pair in weights for p in pair]
    mean, square, step = [np.zeros_like(p) for p in flat], [np.zeros_like(p) for p in flat], 0
    best, kept, curve, waited = math.inf, None, [], 0
    for _ in range(passes):
        order, loss = random.permutation(len(x)), 0.0
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            masks = [(random.random((len(rows), n)) >= dropout) / (1 - dropout) for n in layers]
            part, found = gradients(weights, x[rows], y[rows], masks)
            loss, step = loss + part * len(rows), step + 1
            rate = STEP * math.sqrt(1 - SQUARE_DECAY**step) / (1 - MEAN_DECAY**step)
            for p, m, s, g in zip(flat, mean, square, (g for pair in found for g in pair)):
                m += (1 - MEAN_DECAY) * (g - m)
                s += (1 - SQUARE_DECAY) * (g * g - s)
                p -= rate * m / (np.sqrt(s) + TINY)
        now = mean_loss(margins(weights, watched[0]), watched[1])
        curve.append((loss / max(1, len(x)), now))
        if now < best:
            best, kept, waited = now, [p.copy() for p in flat], 0
        else:
            waited += 1
            if waited >= patience:
                break
    kept = kept or flat
    return list(zip(kept[::2], kept[1::2])), curve


class Network(Estimator):
    """Fits a :class:`NetworkModel` on at most about ``rows_to_fit`` labelled rows, which one task holds.

    ``watched_share`` of them are kept apart to tell when to stop.
    """

    @keyword_only
    def __init__(
        self, *, layers: tuple[int, ...] = LAYERS, dropout: float = 0.2, passes: int = 30, batch: int = 32, patience: int = 10,
        watched_share: float = 0.1, rows_to_fit: int = ROWS_TO_FIT, seed: int = 42,
    ):
        super().__init__()
        self.layers, self.dropout, self.passes, self.batch, self.patience = tuple(layers), dropout, passes, batch, patience
        self.watched_share, self.rows_to_fit, self.seed = watched_share, rows_to_fit, seed

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        width = dataset.schema["features"].metadata["ml_attr"]["num_attrs"]
        how = (self.layers, self.dropout, self.passes, self.batch, self.patience, self.seed)
        share = self.watched_share

        def fit(table: pa.Table) -> pa.Table:
            table = table.sort_by([("place", "ascending"), ("label", "ascending")]).combine_chunks()
            x = dense(table.column("features").combine_chunks(), width)
            y = table.column("label").to_numpy().astype(float)
            # The order by a hash is a random one, so the first rows may stand for all.
            cut = round(share * len(y)) if len(y) > 1 else 0
            watched = (x[:cut], y[:cut]) if cut else (x, y)
            weights, curve = train(x[cut:], y[cut:], watched, *how)
            losses = [watched_loss for _, watched_loss in curve]
            blob = b"".join(p.astype("<f8").tobytes() for pair in weights for p in pair)
            stored = [blob if i == int(np.argmin(losses)) else None for i in range(len(curve))]
            columns = [range(1, len(curve) + 1), [a for a, _ in curve], losses, stored]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CURVE)], schema=CURVE)

        rows = dataset.select(F.col(LABEL).cast("int").alias("label"), "features")
        sample = sample_rows(rows, self.rows_to_fit, self.seed, "label").withColumn("place", F.xxhash64("features"))
        curve = sample.groupBy(F.lit(0).alias("all")).applyInArrow(fit, CURVE_SCHEMA).orderBy("pass").collect()  # a row a pass
        if not curve:
            raise ValueError("no labelled rows to fit a network on")
        blob = next(bytes(r["weights"]) for r in curve if r["weights"] is not None)
        return NetworkModel(width, self.layers, blob, [(r["loss"], r["monitored"]) for r in curve])


class NetworkModel(Model, MLWritable, MLReadable):
    """A fitted network; ``curve`` has the losses on training and on watched rows by pass, of which the best was kept."""

    def __init__(self, width: int, layers: tuple[int, ...], blob: bytes, curve: list[tuple[float, float]]):
        super().__init__()
        self.width, self.layers, self.blob, self.curve = width, tuple(layers), blob, curve

    @property
    def best_pass(self) -> int:
        return 1 + min(range(len(self.curve)), key=lambda i: self.curve[i][1])

    def weights(self) -> Weights:
        sizes, flat, at, out = [self.width, *self.layers, 1], np.frombuffer(self.blob, "<f8"), 0, []
        for a, b in zip(sizes, sizes[1:]):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, width = self.weights(), self.width  # travel with the plan, some kilobytes

        @arrow_udf("double")
        def probability(features: pa.Array) -> pa.Array:
            margin = margins(weights, dense(features, width))
            return pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))

        return with_probability(dataset, probability("features"))

    def write(self) -> MLWriter:
        return _NetworkWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NetworkReader()


class _NetworkWriter(MLWriter):
    def __init__(self, model: NetworkModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        told = {"width": self.model.width, "layers": list(self.model.layers), "curve": self.model.curve}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, told)
        weights = self.sparkSession.createDataFrame([(bytearray(self.model.blob),)], "weights binary")
        weights.write.parquet(f"{path}/weights")


class _NetworkReader(MLReader):
    def load(self, path: str) -> NetworkModel:
        told = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        blob = bytes(self.sparkSession.read.parquet(f"{path}/weights").first()["weights"])
        return NetworkModel(told["width"], told["layers"], blob, [tuple(p) for p in told["curve"]])
