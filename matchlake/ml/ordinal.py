"""Proportional-odds ordered logit.

``P(Y >= k | x) = 1 / (1 + exp(-(a_k + x b)))`` with decreasing intercepts ``a_1 > a_2 > ...``
and one slope vector ``b`` for all of them, so the curves never cross.  The likelihood is
maximised by Newton steps; a step's log-likelihood, gradient and Hessian are one aggregate
over the rows, and only that (levels + slopes) square matrix reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.ml.sums import dot, matrix, summed

TOLERANCE = 1e-12
HALVINGS = 30


@dataclass
class OrderedLogit:
    """``intercepts[k - 1]`` belongs to ``P(Y >= present[k])``; levels that no training row
    has are not in ``present`` and have probability 0."""
    levels: int
    present: list[int]
    intercepts: np.ndarray
    slopes: np.ndarray
    log_likelihood: float
    rows: int
    history: list[float] = field(default_factory=list)

    def probabilities(self, vector: Column) -> list[Column]:
        score = dot(vector, self.slopes) if len(self.slopes) else F.lit(0.0)
        above = [F.lit(1.0), *[1 / (1 + F.exp(-(score + float(a)))) for a in self.intercepts], F.lit(0.0)]
        out = [F.lit(0.0)] * self.levels
        for k, level in enumerate(self.present):
            out[level] = above[k] - above[k + 1]
        return out


def _contributions(present: list[int], intercepts: np.ndarray, slopes: np.ndarray):
    """Sums over a batch: the Hessian, below it the gradient, and the log-likelihood last."""
    m, p = len(intercepts), len(slopes)
    place = {level: k for k, level in enumerate(present)}

    def block(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"), p)
        y = np.array([place[v] for v in batch.column("y").to_numpy(zero_copy_only=False).astype(int).tolist()])
        edges = np.r_[np.inf, intercepts, -np.inf]
        score = x @ slopes
        with np.errstate(over="ignore"):
            upper, lower = 1 / (1 + np.exp(-(edges[y] + score))), 1 / (1 + np.exp(-(edges[y + 1] + score)))
        prob = np.maximum(upper - lower, 1e-300)
        fu, fl = upper * (1 - upper), lower * (1 - lower)
        out = np.zeros((m + p + 2, m + p + 1))
        # indicators of the intercepts above and below a row's level
        above = (y[:, None] == np.arange(1, m + 1)).astype(float)
        below = (y[:, None] == np.arange(m)).astype(float)
        out[:m, m:m + p] = -((above * fu[:, None]).T + (below * fl[:, None]).T) @ x
        out[m:m + p, :m] = out[:m, m:m + p].T
        out[m:m + p, m:m + p] = -(x * (fu + fl)[:, None]).T @ x
        ru, rl = fu / prob, fl / prob
        diagonal = above.T @ (ru * (1 - 2 * upper) - ru * ru) - below.T @ (rl * (1 - 2 * lower) + rl * rl)
        out[:m, :m] = np.diag(diagonal)
        between = (above * ru[:, None]).T @ (below * rl[:, None])  # a level between two intercepts
        out[:m, :m] += between + between.T
        out[m + p, :m] = above.T @ ru - below.T @ rl
        out[m + p, m:m + p] = x.T @ (1 - upper - lower)
        out[m + p + 1, m + p] = np.log(prob).sum()
        return out

    return block


def fit_ordered(train: DataFrame, max_iter: int = 250, features: str = "features", label: str = "label", levels: int = 3) -> OrderedLogit:
    """Fits the model on the vector column ``features`` and the numeric ``label`` (0 ..
    ``levels - 1``).  Rows with a NULL in either are left out; collinear features share their slope (least squares
    step).  One level alone has probability 1; without any row all levels are equally likely."""
    rows = train.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    counts = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n, present = sum(counts.values()), sorted(counts)
    if not n:
        shares = np.arange(levels - 1, 0, -1) / levels
        return OrderedLogit(levels, list(range(levels)), np.log(shares / (1 - shares)), np.zeros(0), 0.0, 0)
    p = rows.select(F.size("x").alias("p")).first()["p"]
    above = np.cumsum([counts[k] for k in reversed(present)])[::-1][1:] / n
    a, b = np.log(above / (1 - above)), np.zeros(p)
    m = len(a)
    if not m:
        return OrderedLogit(levels, present, a, b, 0.0, n)

    def at(a, b):
        sums = summed(rows, _contributions(present, a, b), (m + p + 2, m + p + 1))
        return sums[m + p + 1, m + p], sums[m + p, :m + p], sums[:m + p, :m + p]

    value, gradient, hessian = at(a, b)
    history = [value / n]
    for _ in range(max_iter):
        step = np.linalg.lstsq(-hessian, gradient, rcond=1e-12)[0]
        for _ in range(HALVINGS):
            new_a, new_b = a + step[:m], b + step[m:]
            if (np.diff(new_a) < 0).all():
                found = at(new_a, new_b)
                if found[0] >= value - 1e-12 * abs(value):
                    break
            step = step / 2
        else:
            break
        gain = found[0] - value
        a, b, (value, gradient, hessian) = new_a, new_b, found
        history.append(value / n)
        if gain <= TOLERANCE * abs(value):
            break
    return OrderedLogit(levels, present, a, b, value, n, history)
