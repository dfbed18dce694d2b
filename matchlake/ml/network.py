"""One network with several outputs, fitted by mini-batch gradient steps.

Rows are dealt to shards by a seeded hash and written once, a file for each shard.  An epoch is
one job: a task holds one shard at a time, mixes its rows anew and takes a step (Adam) on the
gradient of the absolute loss of each mini-batch.  Shards take their steps side by side from the
same weights, which are averaged by their rows at the epoch's end; a table of no more than
SHARD_ROWS rows is one shard, and its steps are those of plain mini-batch descent.  What moves between
the driver and the tasks is the model's size, never rows.  The rate falls in stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.ml.sums import PLACED, added, matrix, summed
from matchlake.session import scratch_dir

#: (epochs, rate) one after the other.
STAGES = ((25, 1e-3), (50, 1e-4))
HIDDEN = (64, 32)
BATCH_ROWS = 256  # of a step
SHARD_ROWS = 65_536  # held at once by a task


@dataclass
class Network:
    """Scaling of the inputs, weights of the layers (last row: the intercepts), and the
    mean absolute error of each epoch's steps by target."""

    features: list[str]
    targets: list[str]
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    history: list[list[float]] = field(default_factory=list)

    def outputs(self, x: np.ndarray) -> np.ndarray:
        return _forward((x - self.mean) * self.scale, self.layers)[1]


def _forward(z: np.ndarray, layers: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """What goes into each layer, and the outputs."""
    into = [z]
    for w in layers[:-1]:
        into.append(np.tanh(into[-1] @ w[:-1] + w[-1]))
    return into, into[-1] @ layers[-1][:-1] + layers[-1][-1]


def gradient(z: np.ndarray, y: np.ndarray, layers: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradients of the summed absolute errors by layer, and the sums by target."""
    into, out = _forward(z, layers)
    back, found = np.sign(out - y), []
    for k in reversed(range(len(layers))):
        found.append(np.vstack([into[k].T @ back, back.sum(axis=0)]))
        if k:
            back = (back @ layers[k][:-1].T) * (1 - into[k] * into[k])
    return found[::-1], np.abs(out - y).sum(axis=0)


@dataclass
class _Adam:
    """Weights as one vector, with the moments of their gradients."""
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0

    def step(self, g: np.ndarray, rate: float) -> None:
        self.steps += 1
        self.first = 0.9 * self.first + 0.1 * g
        self.second = 0.999 * self.second + 0.001 * g * g
        self.weights = self.weights - rate * (self.first / (1 - 0.9**self.steps)) / (np.sqrt(self.second / (1 - 0.999**self.steps)) + 1e-8)


def _layers(weights: np.ndarray, shapes: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    cuts = np.cumsum([a * b for a, b in shapes])[:-1]
    return [w.reshape(s) for w, s in zip(np.split(weights, cuts), shapes, strict=True)]


def _dealt(train: DataFrame, features: Sequence[str], targets: Sequence[str], key: str, batches: int | None, shard_rows: int, seed: int) -> tuple[DataFrame, int]:
    """Complete rows as arrays, a file for each shard and in a fixed order there; and their number.
    ``batch`` is the mini-batch that the key's hash deals a row to, if ``batches`` are given."""
    spark = train.sparkSession
    rows = train.dropna(subset=[*features, *targets])
    arrays = [F.array(*[F.col(c).cast("double") for c in cs]) for cs in (features, targets)]
    rows = rows.select(F.col(key).alias("key"), arrays[0].alias("x"), arrays[1].alias("y"))
    n = rows.count()
    h = F.xxhash64("key", "x", "y", F.lit(seed))  # of the whole row: keys may repeat
    batch = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(batches or 1)).cast("int").alias("batch")
    rows = rows.select("x", "y", batch, h.alias("h"), F.pmod(h, F.lit(max(1, -(-n // shard_rows)))).cast("int").alias("shard"))
    path = f"{scratch_dir(spark, 'network-' + uuid.uuid4().hex)}/rows"
    rows.repartition("shard").sortWithinPartitions("shard", "h").select("x", "y", "batch", "shard").write.partitionBy("shard").parquet(path)
    return spark.read.schema("x array<double>, y array<double>, batch int, shard int").parquet(path), n


def _epoch(state: _Adam, shapes: Sequence[tuple[int, int]], turns: Sequence[int] | None, batch_rows: int, rate: float, shard_rows: int, seed: Sequence[int], prepared):
    """An epoch's steps of each shard, from ``state`` on: sums by rows of the weights and moments after
    it, of the errors on the way, and of the rows and steps.  Mini-batches are those of the rows in the order of ``turns``,
    or without it ``batch_rows`` rows as they are mixed."""
    p, q = shapes[0][0] - 1, shapes[-1][1]

    def taken(shard: int, part: int, held: list[pa.RecordBatch]) -> np.ndarray:
        z = prepared(np.concatenate([matrix(b.column("x"), p) for b in held]))
        y = np.concatenate([matrix(b.column("y"), q) for b in held])
        own, errors = _Adam(state.weights, state.first, state.second, state.steps), np.zeros(q)
        if turns is None:
            steps = np.array_split(np.random.default_rng([*seed, shard, part]).permutation(len(z)), -(-len(z) // batch_rows))
        else:
            batch = np.concatenate([b.column("batch").to_numpy(zero_copy_only=False) for b in held])
            steps = [rows for rows in (np.flatnonzero(batch == t) for t in turns) if len(rows)]
        for rows in steps:
            g, e = gradient(z[rows], y[rows], _layers(own.weights, shapes))
            errors += e
            own.step(np.concatenate([w.ravel() for w in g]) / len(rows), rate)
        n = len(z)
        return np.concatenate([own.weights * n, own.first * n, own.second * n, errors, [n, (own.steps - state.steps) * n]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, held, total = None, 0, [], 0.0
        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if batch.num_rows else []
            for a, b in zip(cuts, np.r_[cuts[1:], batch.num_rows], strict=True):
                full = sum(len(h) for h in held) >= 2 * shard_rows  # equal rows, which no hash deals
                if held and (at != shard[a] or full):
                    total = total + taken(at, part, held)
                    held, part = [], part + 1 if at == shard[a] else 0
                at = int(shard[a])
                held.append(batch.slice(a, b - a))
        if held:
            total = total + taken(at, part, held)
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total], pa.list_(pa.float64()))], names=["place", "v"])

    return run


def fit_network(train: DataFrame, features: Sequence[str], targets: Sequence[str], key: str, *, hidden: int | Sequence[int] = HIDDEN, batches: int | None = None,
                stages: Sequence[tuple[int, float]] = STAGES, seed: int = 123, batch_rows: int = BATCH_ROWS, shard_rows: int = SHARD_ROWS) -> Network:
    """A network of the ``hidden`` layers for all ``targets``, under absolute loss.

    A step takes ``batch_rows`` rows, mixed anew in each epoch, or one of the ``batches`` that the key's hash deals rows to.  Rows with a NULL feature or target
    take no part; without any row the weights stay as drawn and the history is empty.  The seed gives
    the shards, the order of their rows and the first weights; sums over shards may differ in their last digits.
    """
    features, targets = list(features), list(targets)
    p, q = len(features), len(targets)
    rows, n = _dealt(train, features, targets, key, batches, shard_rows, seed)

    def moments(batch) -> np.ndarray:
        x = matrix(batch.column("x"), p)
        return np.stack([x.sum(axis=0), (x * x).sum(axis=0)])

    s, square = summed(rows.select("x"), moments, (2, p))
    mean = s / max(n, 1)
    spread = np.sqrt(np.maximum(square / max(n, 1) - mean * mean, 0.0))
    scale = np.divide(1.0, spread, out=np.zeros(p), where=spread > 1e-12)
    rng = np.random.default_rng(seed)
    sizes = [p, *([hidden] if isinstance(hidden, int) else hidden), q]
    layers = [np.vstack([rng.normal(0, 1 / np.sqrt(a), (a, b)), np.zeros(b)]) for a, b in zip(sizes, sizes[1:], strict=False)]
    net = Network(features, targets, mean, scale, layers)
    shapes = [w.shape for w in layers]
    weights = np.concatenate([w.ravel() for w in layers])
    m = len(weights)
    state = _Adam(weights, np.zeros(m), np.zeros(m))
    for epoch, rate in enumerate([rate for epochs, rate in stages for _ in range(epochs)] if n else []):
        run = _epoch(state, shapes, rng.permutation(batches) if batches else None, batch_rows, rate, shard_rows, (seed, epoch), lambda x: (x - mean) * scale)
        total = added(rows.mapInArrow(run, PLACED), (1, 3 * m + q + 2))[0]
        w, first, second, errors, (seen, steps) = np.split(total, [m, 2 * m, 3 * m, 3 * m + q])
        state = _Adam(w / seen, first / seen, second / seen, state.steps + round(steps / seen))
        net.history.append((errors / seen).tolist())
    net.layers = _layers(state.weights, shapes)
    return net


def predict_network(net: Network, df: DataFrame) -> DataFrame:
    """``pred_<target>`` for each target; NULL where a feature is NULL."""

    p, q = len(net.features), len(net.targets)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def outputs(x: pa.Array) -> pa.Array:
        y = net.outputs(matrix(x, p))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, q, dtype=np.int32)), pa.array(y.ravel()))

    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in net.features])
    known = F.array(*[F.col(c).isNotNull() for c in net.features])
    scored = df.withColumn("__out", F.when(F.forall(known, lambda k: k), outputs(values)))
    return scored.select(*df.columns, *[F.col("__out")[i].alias(f"pred_{t}") for i, t in enumerate(net.targets)])


def history(net: Network, df: DataFrame) -> DataFrame:
    """Mean absolute error of each epoch's steps: target, round, metric."""
    rows = [(t, r + 1, float(e[i])) for r, e in enumerate(net.history) for i, t in enumerate(net.targets)]
    return df.sparkSession.createDataFrame(rows, "target string, round int, metric double")
