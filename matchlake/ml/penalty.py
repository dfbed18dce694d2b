"""Path of penalties for the multinomial logit (lasso, elastic net).

The loss is the mean negative log-likelihood plus ``penalty * (alpha |b|_1 + (1 - alpha) / 2 |b|_2^2)`` over
the slopes of features scaled to spread 1; intercepts are free.  The largest useful penalty, at which all
slopes are zero, follows from one gradient at the model without slopes.  Below it lies a log grid, and each
penalty starts from the solution of the one before.  A step is a Newton step whose quadratic is solved on the driver by coordinate
descent; its gradient and Hessian are one aggregate over the rows.  The models that leave out a fold take their steps in the
same passes as the model on all rows.  The driver holds classes x features square matrices, one for each model.

Rows with a NULL label or vector are left out; a constant feature has slope 0; a feature of NaN is an error of the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.ml.sums import dot, matrix, summed

STEPS = 25       # Newton steps of a penalty at most
SWEEPS = 1000    # of coordinate descent at most
SMALL = 1e-6     # largest change of a coefficient that ends a penalty


@dataclass
class Path:
    """``coefficients[i]`` is classes x (features + 1) in the features' own units, the intercept last.
    ``held_out[i]`` is the mean loss on the folds left out (NaN without folds), and ``best`` its least place."""
    penalties: np.ndarray
    coefficients: np.ndarray
    held_out: np.ndarray
    steps: int

    @property
    def best(self) -> int:
        return int(np.nanargmin(self.held_out)) if np.isfinite(self.held_out).any() else len(self.penalties) - 1

    def probabilities(self, vector: Column, at: int | None = None) -> list[Column]:
        scores = [dot(vector, b[:-1]) + float(b[-1]) for b in self.coefficients[self.best if at is None else at]]
        top = F.greatest(*scores)
        parts = [F.exp(s - top) for s in scores]
        return [p / sum(parts[1:], parts[0]) for p in parts]


def _block(models: list[tuple[int, np.ndarray]], mean: np.ndarray, scale: np.ndarray):
    """For each (fold left out, coefficients): the Hessian, the gradient, and a last row with loss
    and rows of the rows taken, then of those left out."""
    classes, width = models[0][1].shape
    size = classes * width

    def block(batch: pa.RecordBatch) -> np.ndarray:
        z = np.c_[(matrix(batch.column("x"), width - 1) - mean) * scale, np.ones(batch.num_rows)]
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(int)
        fold = batch.column("fold").to_numpy(zero_copy_only=False)
        truth = np.eye(classes)[y]
        out = []
        for left, b in models:
            score = z @ b.T
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))
            took = (fold != left).astype(float)
            part = np.zeros((size + 2, size))
            for k in range(classes):
                for m in range(k, classes):
                    h = z.T @ (z * (took * p[:, k] * ((k == m) - p[:, m]))[:, None])
                    part[k * width:(k + 1) * width, m * width:(m + 1) * width] = h
                    part[m * width:(m + 1) * width, k * width:(k + 1) * width] = h
            part[size] = (((p - truth) * took[:, None]).T @ z).ravel()
            part[size + 1, :4] = (loss * took).sum(), took.sum(), (loss * (1 - took)).sum(), (1 - took).sum()
            out.append(part)
        return np.concatenate(out)

    return block


def _descend(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, lasso: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """The change of ``b`` that minimises the penalised quadratic."""
    d, slope = np.zeros_like(b), gradient.copy()
    for _ in range(SWEEPS):
        largest = 0.0
        for j in np.flatnonzero(np.diag(hessian) > 1e-12):
            curve = hessian[j, j] + ridge[j]
            old = b[j] + d[j]
            aim = hessian[j, j] * old - slope[j]
            new = np.sign(aim) * max(abs(aim) - lasso[j], 0.0) / curve
            if new != old:
                d[j] += new - old
                slope += hessian[:, j] * (new - old)
                largest = max(largest, abs(new - old))
        if largest < SMALL / 100:
            break
    return d


def penalty_path(train: DataFrame, alpha: float, points: int = 50, least: float = 1e-4, folds: int = 10, key: str | None = None,
                 features: str = "features", label: str = "label", classes: int = 3) -> Path:
    """Fits ``points`` penalties from the largest useful one down to ``least`` times it.  Folds are by the
    hash of ``key`` (of the features without one); ``folds`` below 2 fits no held-out models."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    fold = F.pmod(F.xxhash64(F.col(key) if key else vector_to_array(features)), F.lit(max(folds, 1)))
    rows = train.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    rows = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), fold.cast("long").alias("fold"), F.col(features).alias("__v"))
    stats = rows.agg(Summarizer.metrics("mean", "std", "count").summary(F.col("__v")).alias("s")).select("s.*").first()
    if not stats["count"]:
        raise ValueError("no training rows")
    rows = rows.drop("__v")
    mean, spread = stats["mean"].toArray(), stats["std"].toArray()
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    width = len(mean) + 1
    size = classes * width
    free = np.tile(np.arange(width) == width - 1, classes)

    def at(models):
        sums = summed(rows, _block(models, mean, scale), (len(models) * (size + 2), size))
        return [(s[:size] / s[size + 1, 1], s[size] / s[size + 1, 1], s[size + 1, 0] / s[size + 1, 1], s[size + 1, 2:4]) if s[size + 1, 1] else None
                for s in np.split(sums, len(models))]

    n = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = np.array([max(n.get(k, 0), 1e-9) for k in range(classes)], float)
    start = np.zeros((classes, width))
    start[:, -1] = np.log(shares / shares.sum())
    largest = np.abs(at([(-1, start)])[0][1][~free]).max() / alpha
    grid = largest * np.logspace(0, np.log10(least), points) if points > 1 else np.array([largest])

    lefts = [-1, *(range(folds) if folds > 1 else [])]
    now = {f: start.copy() for f in lefts}
    coefficients, held, steps = [], [], 0
    for penalty in grid:
        lasso, ridge = np.where(free, 0.0, penalty * alpha), np.where(free, 0.0, penalty * (1 - alpha))
        active, last, out = list(lefts), {}, {}
        for _ in range(STEPS):
            steps += 1
            found = dict(zip(active, at([(f, now[f]) for f in active]), strict=True))
            for f, sums in found.items():
                if sums is None:  # all rows are in the fold left out
                    active.remove(f)
                    continue
                hessian, gradient, loss, rest = sums
                b = now[f].ravel()
                value = loss + (lasso * np.abs(b)).sum() + (ridge * b * b).sum() / 2
                if f in last and value > last[f][0] + 1e-12:  # too far: half the way back
                    now[f] = (now[f] + last[f][1]) / 2
                    continue
                out[f] = rest
                d = _descend(b, gradient, hessian, lasso, ridge)
                if np.abs(d).max() < SMALL:
                    active.remove(f)
                    continue
                last[f] = (value, now[f])
                now[f] = (b + d).reshape(classes, width)
            if not active:
                break
        own = now[-1][:, :-1] * scale
        coefficients.append(np.c_[own, now[-1][:, -1] - own @ mean])
        left = np.array([out[f] for f in lefts[1:] if f in out]).reshape(-1, 2).sum(axis=0)
        held.append(left[0] / left[1] if left[1] else np.nan)
    return Path(grid, np.array(coefficients), np.array(held), steps)
