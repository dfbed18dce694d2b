"""Proportional-odds logit and block sums against dense numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from matchlake.ml import features, models, ordinal, sums


def _dense_fit(x, y, levels):
    """Gradient ascent with backtracking on the same likelihood, with gaps between thresholds."""
    def unpack(p):
        return np.r_[p[0], p[0] - np.cumsum(np.exp(p[1:levels - 1]))], p[levels - 1:]

    def value(p):
        a, b = unpack(p)
        edges = np.r_[np.inf, a, -np.inf]
        s = x @ b
        return np.log(1 / (1 + np.exp(-(edges[y] + s))) - 1 / (1 + np.exp(-(edges[y + 1] + s)))).mean()

    p, h = np.zeros(levels - 1 + x.shape[1]), 1e-6
    for _ in range(60):  # Newton with numeric derivatives
        k = len(p)
        e = np.eye(k) * 1e-4
        g = np.array([(value(p + e[i]) - value(p - e[i])) / 2e-4 for i in range(k)])
        hess = np.array([[(value(p + e[i] + e[j]) - value(p + e[i] - e[j]) - value(p - e[i] + e[j]) + value(p - e[i] - e[j])) / 4e-8 for j in range(k)] for i in range(k)])
        p = p - np.linalg.solve(hess - h * np.eye(k), g)
    return unpack(p), value(p)


@pytest.mark.parametrize("levels", [3, 4])
def test_ordered_fit_agrees_with_a_dense_one(spark, levels):
    rng = np.random.default_rng(levels)
    x = rng.normal(size=(400, 3))
    y = np.digitize(x @ [1.0, -0.5, 0.2] + rng.logistic(size=400), np.linspace(-1, 1.5, levels - 1))
    df = spark.createDataFrame([(list(map(float, r)), float(k)) for r, k in zip(x, y)] + [(None, 1.0), ([0.0] * 3, None)], "v array<double>, label double").repartition(3)
    fit = ordinal.fit_ordered(df.select(F.when(F.col("v").isNotNull(), array_to_vector("v")).alias("features"), "label"), levels=levels)
    (a, b), best = _dense_fit(x, y, levels)
    assert np.allclose(fit.intercepts, a, atol=1e-4) and np.allclose(fit.slopes, b, atol=1e-4)
    assert fit.rows == 400 and abs(fit.log_likelihood / 400 - best) < 1e-7
    assert all(q >= p - 1e-9 for p, q in zip(fit.history, fit.history[1:]))
    shares = df.where("v IS NOT NULL").select(*[p.alias(f"p{i}") for i, p in enumerate(fit.probabilities(F.col("v")))]).collect()
    assert all(min(r) > 0 and abs(sum(r) - 1) < 1e-9 for r in shares)


def test_ordered_fit_of_odd_tables(spark):
    def fit(rows):
        return ordinal.fit_ordered(spark.createDataFrame(rows, "v array<double>, label double").select(array_to_vector("v").alias("features"), "label"))

    assert [round(float(v), 6) for v in fit([([1.0], 1.0)] * 3).intercepts] == []
    none = spark.createDataFrame([], "v array<double>, label double").select(array_to_vector("v").alias("features"), "label")
    assert np.allclose(ordinal.fit_ordered(none).intercepts, [np.log(2), -np.log(2)])
    # a level without rows has probability 0; equal columns share their slope
    rng = np.random.default_rng(9)
    x = rng.normal(size=200)
    y = 2.0 * (x + rng.logistic(size=200) > 0)
    m = fit([([float(v), float(v)], float(k)) for v, k in zip(x, y)])
    assert m.present == [0, 2] and abs(m.slopes[0] - m.slopes[1]) < 1e-9
    one = spark.createDataFrame([([0.3, 0.3],)], "v array<double>").select(*[p.alias(f"p{i}") for i, p in enumerate(m.probabilities(F.col("v")))]).first()
    assert one[1] == 0 and abs(sum(one) - 1) < 1e-12


def test_ordered_predictions_never_cross(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, ["Lose", "Draw", "Win"][i % 3], float(i % 3 - 1 + rng.normal() * 3), float(rng.normal())) for i in range(300)], "id long, outcome string, f1 double, f2 double")
    d = models.prepare(df, ["f1", "f2"], "outcome")
    p = models.predict_ordered(models.ordered_logit(d), d.union(d.limit(5)))
    low = p.agg(F.min(F.least("p_lose", "p_draw", "p_win")), F.max(F.abs(F.col("p_lose") + F.col("p_draw") + F.col("p_win") - 1))).first()
    assert low[0] > 0 and low[1] < 1e-12


def test_wide_gramian(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 230)) @ rng.normal(size=(230, 230)) + 1e3
    x[:, 5] = 7.0  # does not vary
    cols = [f"c{i}" for i in range(230)]
    rows = [[float(v) for v in r] for r in x]
    rows[3][0] = rows[9][1] = None
    rows[4][0] = float("nan")
    df = spark.createDataFrame([(r,) for r in rows], "a array<double>").select(*[F.col("a")[i].alias(c) for i, c in enumerate(cols)]).repartition(3)
    got = {(r.col_a, r.col_b): r.corr for r in features.corr_matrix(df, cols).collect()}
    assert len(got) == 230 * 230 and got["c5", "c8"] is None
    keep = np.ones(150, bool)
    keep[[3, 4, 9]] = False
    assert abs(got["c0", "c1"] - np.corrcoef(x[keep, 0], x[keep, 1])[0, 1]) < 1e-9
    want = np.corrcoef(x[:, 6:].T)
    assert max(abs(got[f"c{i}", f"c{j}"] - want[i - 6, j - 6]) for i in range(6, 230, 7) for j in range(6, 230, 5)) < 1e-9
    empty = features.corr_matrix(df.limit(0), cols[:3]).collect()
    assert len(empty) == 9 and all(r.corr is None for r in empty)


def test_summed_adds_batches(spark):
    df = spark.range(1000).repartition(7).select(F.col("id").cast("double").alias("x"))
    total = sums.summed(df, lambda b: np.array([[b.column("x").to_numpy().sum(), b.num_rows]]), (1, 2))
    assert total.tolist() == [[499500.0, 1000.0]]
