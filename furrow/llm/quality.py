"""Quality scores from random-indexing word vectors and a two-layer network.

Every token owns a sparse random index vector, derived from its hash. A token's word vector is the sum of the index
vectors that stand near it in the sample, scaled to unit length. A word that only repeats the one before it counts as
the token ``<again>``. A document is the mean of its word vectors; a network with one hidden layer, written in numpy,
gives its probability, calibrated by one temperature.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.sampling import sample_per_class
from furrow.llm.tables import documents, values
from furrow.schemas import require_columns
from furrow.workspace import materialize

DIMENSIONS = 64
NONZERO = 4
REACH = 2  # neighbours on each side
HIDDEN = 32
TOKENS = re.compile(r"\w+|[^\w\s]+")
SAMPLE_PARTS = 16
HELD_WORDS = 250_000  # words a task remembers
CONTEXT_SCHEMA = "token int, context binary"
CONTEXT = pa.schema([("token", pa.int32()), ("context", pa.binary())])


def shape(token: str) -> str:
    """What stands for a token outside the vocabulary: its kind and, for words, its case."""
    if not token.isalpha():
        if not (token[0].isalnum() or token[0] == "_"):
            return "<sign>"
        if any(c.isdigit() for c in token):
            return "<digits>"
    if token.isupper():
        return "<UPPER>"
    return "<Title>" if token[0].isupper() else "<lower>"


AGAIN = "<again>"
FIXED_TOKENS = ["<sign>", "<digits>", "<UPPER>", "<Title>", "<lower>", AGAIN]


def tokens_of(text: bytes) -> list[str]:
    """Runs of word characters and of signs, in the words between blanks."""
    out, before = [], None
    for raw in text.split():
        if raw == before:
            out.append(AGAIN)
        else:
            out.extend(TOKENS.findall(raw.decode("utf-8", "replace")))
        before = raw
    return out


def index_vector(token: str) -> np.ndarray:
    """Sparse vector of ``NONZERO`` signs at places that the token's hash names."""
    bits, out = xxhash.xxh3_128_intdigest(token.encode("utf-8")), np.zeros(DIMENSIONS, np.float32)
    for _ in range(NONZERO):
        out[bits % DIMENSIONS] += 1 if bits & (1 << 20) else -1
        bits >>= 24
    return out


@dataclass
class QualityModel:
    """Word vectors (row per token of ``vocabulary``) and the network over their mean."""

    vocabulary: dict[str, int]
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    hidden: tuple[np.ndarray, np.ndarray]
    output: tuple[np.ndarray, float]
    temperature: float = 1.0

    def ids(self, tokens: list[str]) -> list[int]:
        get = self.vocabulary.get
        return [i if (i := get(t)) is not None else self.vocabulary[shape(t)] for t in tokens]

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.mean) / self.spread
        return np.tanh(x @ self.hidden[0] + self.hidden[1]) @ self.output[0] + self.output[1]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -50, 50)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_label: int = 8_000,
    words: int | None = 20_000,
) -> QualityModel:
    """Learn from the labelled rows of ``docs``.

    About ``docs_per_label`` documents of each label, chosen by a hash of the id, teach word vectors and network; a
    label's share among all labelled rows is kept by weights. The vocabulary has at most ``words`` tokens, or all with ``None``. The last
    fifth of the sample, by the hash, sets the temperature. Of several labels of one id the smallest counts. Rows
    without id, text or label teach nothing; without any row the model scores 0.5.
    """
    require_columns(labels, [id_col, label_col])
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = materialize(sample_per_class(known, "label", "doc_id", docs_per_label), "quality-labels")
    texts = documents(docs, id_col, text_col).where("text is not null")
    sample = materialize(texts.join(F.broadcast(chosen), "doc_id").repartition(SAMPLE_PARTS), "quality-sample")

    counted = sample.select("text").mapInArrow(_count, "token string, n long")
    common = counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token")
    common = common if words is None else common.limit(words)
    tokens = FIXED_TOKENS + [r["token"] for r in common.collect()]
    vocabulary = {token: i for i, token in enumerate(dict.fromkeys(tokens))}
    index = np.stack([index_vector(t) for t in vocabulary])
    blank = QualityModel(
        vocabulary, index, np.zeros(DIMENSIONS), np.ones(DIMENSIONS),
        (np.zeros((DIMENSIONS, HIDDEN)), np.zeros(HIDDEN)), (np.zeros(HIDDEN), 0.0),
    )
    shared = sample.sparkSession.sparkContext.broadcast(blank)
    parts = sample.select("text").mapInArrow(lambda b: _contexts(b, shared.value), CONTEXT_SCHEMA)
    summed = parts.groupBy("token").applyInArrow(_sum_contexts, CONTEXT_SCHEMA)
    vectors = index.copy()
    for token, context in summed.collect():  # a row per token of the vocabulary
        vectors[token] = np.frombuffer(context, np.float32)
    blank.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)

    shared = sample.sparkSession.sparkContext.broadcast(blank)
    pooled = sample.select("doc_id", "text").mapInArrow(lambda b: _pool(b, shared.value), "doc_id long, pooled binary")
    rows = pooled.join(chosen, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").collect()  # the bounded sample
    if len({r["label"] for r in rows}) > 1:
        x = np.stack([np.frombuffer(r["pooled"], np.float32) for r in rows]).astype(float)
        train(blank, x, np.array([r["label"] for r in rows], float), np.array([r["weight"] for r in rows], float))
    return blank


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in values(batch.column(0)):
            counts.update(tokens_of(text))
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["token", "n"])


def _contexts(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((len(model.vocabulary), DIMENSIONS), np.float32)
    for batch in batches:
        for text in values(batch.column(0)):
            ids = np.array(model.ids(tokens_of(text)), np.int64)
            own = model.vectors[ids]
            near = own.copy()
            for step in range(1, min(REACH, len(ids) - 1) + 1):
                near[step:] += own[:-step]
                near[:-step] += own[step:]
            np.add.at(sums, ids, near)
    seen = np.flatnonzero(sums.any(1))
    columns = [pa.array(seen, pa.int32()), pa.array([row.tobytes() for row in sums[seen]], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, schema=CONTEXT)


def _sum_contexts(table: pa.Table) -> pa.Table:
    parts = np.stack([np.frombuffer(c, np.float32) for c in values(table.column("context"))])
    return pa.Table.from_arrays([table.column("token")[:1], pa.array([parts.sum(0).tobytes()], pa.binary())], schema=CONTEXT)


class _Vectors(dict):
    """Row of a matrix of summed word vectors per word between blanks; the last value is its number of tokens."""

    def __init__(self, model: QualityModel):
        super().__init__()
        self.model = model
        self.rows = np.zeros((HELD_WORDS, DIMENSIONS + 1), np.float32)
        self.again = np.append(model.vectors[model.vocabulary[AGAIN]], np.float32(1))

    def __missing__(self, raw: bytes) -> int:
        ids = self.model.ids(TOKENS.findall(raw.decode("utf-8", "replace")))
        row = self[raw] = len(self)
        self.rows[row, :-1] = self.model.vectors[ids[0]] if len(ids) == 1 else self.model.vectors[ids].sum(0)
        self.rows[row, -1] = len(ids)
        return row

    def pooled(self, text: bytes | None) -> np.ndarray:
        words, out, before = (text or b"").split(), np.zeros(DIMENSIONS + 1), None
        for at in range(0, len(words), HELD_WORDS // 2):
            part = words[at : at + HELD_WORDS // 2]
            if len(self) + len(part) > HELD_WORDS:
                self.clear()
            rows = np.array(list(map(self.__getitem__, part)))
            fresh = np.append(part[0] != before, rows[1:] != rows[:-1])
            out += self.rows[rows[fresh]].sum(0, dtype=float) + (len(part) - fresh.sum()) * self.again
            before = part[-1]
        return out[:-1] / max(1.0, out[-1])


def _pool(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    vectors = _Vectors(model)
    for batch in batches:
        pooled = [vectors.pooled(text).astype(np.float32).tobytes() for text in values(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pooled, pa.binary())], ["doc_id", "pooled"])


def train(model: QualityModel, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 40) -> None:
    """Fit network and temperature in place; the last fifth of the rows is for the temperature alone."""
    cut = max(1, len(x) * 4 // 5)
    rest = slice(cut, None) if cut < len(x) else slice(0, None)
    model.mean, model.spread = x[:cut].mean(0), x[:cut].std(0) + 1e-6
    z, weight = (x - model.mean) / model.spread, weight / weight.mean()
    random = np.random.default_rng(11)
    p = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 0.2, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = random.permutation(cut)
        for at in range(0, cut, 128):
            rows = order[at : at + 128]
            h = np.tanh(z[rows] @ p[0] + p[1])
            error = weight[rows] * (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(0), h.T @ error + 1e-4 * p[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    model.hidden, model.output = (p[0], p[1]), (p[2], float(p[3][0]))
    logits = model.logits(x[rest])

    def loss(t: float) -> float:
        return float((weight[rest] * np.logaddexp(0, np.where(y[rest] > 0, -1, 1) * logits / t)).sum())

    # Above one only: a network that makes no error on those rows says nothing on how sure it may be.
    model.temperature = float(min(np.geomspace(1, 8, 61), key=loss))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row; null counts as empty, and an empty text scores like a mean of no words.

    Repeated rows score alike; an empty table gives an empty result; other columns take no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size bounded by the parameters of fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pool(batches, shared.value):
            pooled = np.stack([np.frombuffer(b, np.float32) for b in values(batch.column(1))])
            scores = shared.value.probability(pooled.astype(float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
