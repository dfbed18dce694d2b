"""The two-output network: its gradient, its fit on both targets at once, and its edges."""

import numpy as np
import pytest

from matchlake.ml.network import fit_network, gradient, history, predict_network

COLUMNS = "id long, a double, b double, flat double, left_y double, right_y double"


def test_gradient_matches_differences():
    rng = np.random.default_rng(3)
    z, y = rng.normal(size=(40, 3)), rng.normal(size=(40, 2))
    layers = [rng.normal(size=(4, 5)), rng.normal(size=(6, 2))]
    g, errors = gradient(z, y, layers)
    assert errors.shape == (2,)
    for k, w in enumerate(layers):
        for at in [(0, 0), (w.shape[0] - 1, w.shape[1] - 1)]:
            ends = []
            for d in (1e-6, -1e-6):
                moved = [m.copy() for m in layers]
                moved[k][at] += d
                ends.append(gradient(z, y, moved)[1].sum())
            assert (ends[0] - ends[1]) / 2e-6 == pytest.approx(g[k][at], rel=1e-3, abs=1e-3)


def test_one_network_learns_both_targets(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 2)) * [1, 10] + [0, 50]
    y = np.c_[np.abs(x[:, 0]), x[:, 0] - 0.2 * (x[:, 1] - 50)]
    rows = [(i, float(a), float(b), 1.0, float(u), float(v)) for i, ((a, b), (u, v)) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame([*rows, (600, None, 1.0, 1.0, 0.0, 0.0)], COLUMNS)
    net = fit_network(df, ["a", "b", "flat"], ["left_y", "right_y"], "id", hidden=12, batches=3, stages=((25, 3e-2), (5, 3e-3)))
    assert len(net.history) == 30 and history(net, df).count() == 60
    plain = np.abs(y - np.median(y, axis=0)).mean(axis=0)
    assert (np.array(net.history[-1]) < 0.4 * plain).all()
    got = {r["id"]: (r["pred_left_y"], r["pred_right_y"]) for r in predict_network(net, df).collect()}
    assert got.pop(600) == (None, None)
    errors = np.abs(np.array([got[i] for i in range(600)]) - y).mean(axis=0)
    assert (errors < 0.4 * plain).all()


def test_no_rows(spark):
    df = spark.createDataFrame([], COLUMNS)
    net = fit_network(df, ["a", "b"], ["left_y"], "id", batches=2, stages=((1, 1e-3),))
    assert net.history == [] and predict_network(net, df).count() == 0
