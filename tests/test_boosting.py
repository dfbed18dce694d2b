"""Histogram boosting against a plain numpy version."""

import numpy as np
from pyspark.sql import functions as F

from matchlake.ml import boosting, evaluate, models


def _plain(x, y, point, rounds, classes, edges):
    """The same trees grown by looking at every cut of every node's rows."""
    bins = boosting.binned(x, edges)
    scores = np.zeros((len(x), classes))
    unit = boosting.UNIT

    def grow(rows, g, h, depth, out):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-9, None)
        if depth < point.depth:
            for f in range(x.shape[1]):
                for cut in range(boosting.BINS - 1):
                    left = rows[bins[rows, f] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    if min(hl, hs - hl) < point.min_child_weight:
                        continue
                    gain = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, cut))
        if best[1] is None:
            out[rows] = -point.step * gs / (hs + 1)
            return
        f, cut = best[1]
        grow(rows[bins[rows, f] <= cut], g, h, depth + 1, out)
        grow(rows[bins[rows, f] > cut], g, h, depth + 1, out)

    for _ in range(rounds):
        p = boosting.shares(scores)
        new = np.zeros_like(scores)
        for c in range(classes):
            g = np.rint((p[:, c] - (y == c)) * unit) / unit
            h = np.rint(np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-6) * unit) / unit
            grow(np.arange(len(x)), g, h, 0, new[:, c])
        scores += new
    return boosting.shares(scores)


def _data(spark, n=300, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 3] = np.rint(x[:, 3])
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=n) > 0).astype(int) + (x[:, 3] > 0)
    df = spark.createDataFrame([(i, i % 5, list(map(float, v)), int(k)) for i, (v, k) in enumerate(zip(x, y))], "h long, fold int, x array<double>, y int").repartition(3)
    return x, y, df


def test_trees_equal_the_plain_version(spark):
    x, y, df = _data(spark)
    point = boosting.Point(step=0.4, depth=3, min_child_weight=2.0)
    both = boosting.boost(df, [(point, -1), (point, 2)], rounds=5, keep=2)
    for model, rows in ((both[0], np.ones(len(x), bool)), (both[1], np.arange(len(x)) % 5 != 2)):
        want = _plain(x[rows], y[rows], point, 5, 3, model.edges)
        got = boosting.shares(model.scores(boosting.binned(x[rows], model.edges)))
        assert np.allclose(got, want, atol=1e-9)
    left = np.arange(len(x)) % 5 == 2
    p = boosting.shares(both[1].scores(boosting.binned(x[left], both[1].edges)))
    assert abs(both[1].losses[-1] + np.log(p[np.arange(left.sum()), y[left]]).mean()) < 1e-5
    assert abs(both[1].losses[0] - np.log(3)) < 1e-5 and not both[0].losses
    found = df.select("h", boosting.probabilities(both[0], F.col("x")).alias("p")).orderBy("h").collect()
    assert np.allclose([r.p for r in found], boosting.shares(both[0].scores(boosting.binned(x, both[0].edges))))


def test_models_grow_alone_as_side_by_side_and_rerun_alike(spark):
    _, _, df = _data(spark, 200, 4)
    points = [boosting.Point(step=0.5, depth=2, subsample=0.7, colsample=0.5), boosting.Point(step=0.2, depth=1)]
    both = boosting.boost(df, [(p, 0) for p in points], rounds=4)
    for k, p in enumerate(points):
        alone = boosting.boost(df.repartition(5), [(p, 0)], rounds=4)[0]
        assert alone.losses == both[k].losses
        assert all((a.feature == b.feature).all() and (a.value == b.value).all() for s, t in zip(alone.rounds, both[k].rounds) for a, b in zip(s, t))


def test_early_stop_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    noise = spark.createDataFrame([(i, int(i % 4 == 0), [float(rng.normal()), float("nan"), 1.0], int(rng.integers(0, 3))) for i in range(200)], "h long, fold int, x array<double>, y int")
    m = boosting.boost(noise, [(boosting.Point(step=0.8, depth=4), 1)], rounds=60, patience=3)[0]
    assert len(m.losses) - 1 == m.best + 3 < 30  # noise: it stops soon
    assert all(t.feature.max() <= 0 for r in m.rounds for t in r)  # constants and NaN split nothing
    none = boosting.boost(noise.limit(0), [(boosting.Point(), 1)], rounds=3)[0]
    assert none.rounds == []
    one = boosting.boost(noise.where("y = 1"), [(boosting.Point(), -1)], rounds=2)[0]
    assert one.scores(boosting.binned(np.zeros((1, 3)), one.edges)).argmax() == 1


def test_boosting_separates_and_tunes_in_shared_passes(spark):
    rng = np.random.default_rng(7)
    rows = [(i, ["Lose", "Draw", "Win"][i % 3], float(3 * (i % 3) + rng.normal()), float(rng.normal())) for i in range(900)]
    d = models.prepare(spark.createDataFrame(rows, "fixture_id long, outcome string, f1 double, f2 double"), ["f1", "f2"], "outcome").cache()
    train, test = d.where("fixture_id < 450"), d.where("fixture_id >= 450")
    m = models.fit_boosted(train, step=0.3, rounds=12, depth=2, key="fixture_id", patience=4)
    assert 1 <= m.best <= 12 and min(m.losses) == m.losses[m.best] < m.losses[0]
    pred = models.predict_boosted(m, test)
    assert evaluate.accuracy(pred, "outcome", "prediction_label").first().accuracy > 0.85
    assert models.log_loss(pred) < 0.5 * np.log(3)
    table = models.tune_boosted(train, {"depth": [1, 2], "step": [0.3, 0.6], "subsample": [1.0, 0.8]}, "fixture_id", folds=2, rounds=3).collect()
    assert len(table) == 8 and [r.score for r in table] == sorted(r.score for r in table) and all(r.rounds <= 3 for r in table)
