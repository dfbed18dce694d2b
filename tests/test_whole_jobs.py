"""The registered queries do the whole job of their methods."""

import numpy as np
import pytest

from matchlake import catalog
from matchlake.ml import boosting, kernel, models, network


def test_forest_has_all_its_trees(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, train: asked.append(self.getNumTrees()))
    monkeypatch.setattr(models, "predict_classes", lambda model, te: None)
    catalog.METHODS["random_forest"](None, None)
    assert asked == [500]


def test_score_network_takes_steps_of_256_rows_for_75_epochs(spark, monkeypatch):
    rng, steps = np.random.default_rng(4), []
    x = rng.normal(size=(600, 2))
    df = spark.createDataFrame([(i, *map(float, v), float(abs(v[0])), float(v[1]), "train") for i, v in enumerate(x)],
                               "fixture_id long, a double, b double, away_goals double, home_goals double, split string").coalesce(1)
    monkeypatch.setattr(catalog, "_score_frame", lambda spark, sf_dir: df)
    fit, kept = network.fit_network, []
    monkeypatch.setattr(network, "fit_network", lambda *a, **k: kept.append(fit(*a, **k)) or kept[0])
    errors = catalog.score_network(spark, None)
    assert len(kept[0].history) == 75 and [w.shape for w in kept[0].layers] == [(3, 64), (65, 32), (33, 2)]
    assert sum(kept[0].history[-1]) < 0.7 * sum(kept[0].history[0]) and errors.where("split = 'train'").first()["mae_total"] > 0
    real = network._Adam.step
    monkeypatch.setattr(network._Adam, "step", lambda self, g, rate: steps.append(rate) or real(self, g, rate))
    state = network._Adam(np.zeros(2), np.zeros(2), np.zeros(2))
    import pyarrow as pa

    held = pa.RecordBatch.from_arrays([pa.array(x[:, :1].tolist()), pa.array(x[:, 1:].tolist()), pa.array([0] * 600, pa.int32())], names=["x", "y", "shard"])
    run = network._epoch(state, [(2, 1)], None, network.BATCH_ROWS, 1e-3, network.SHARD_ROWS, (1, 0), lambda v: v)
    assert network.BATCH_ROWS == 256 and len(list(run(iter([held])))) == 1 and len(steps) == 3


def test_shards_give_what_one_shard_does(spark):
    """Rows that no hash deals are cut, and weights are averaged by rows."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 2))
    df = spark.createDataFrame([(None, *map(float, v), float(v[0] - v[1])) for v in x], "id long, a double, b double, y double")
    plain = np.abs(x[:, 0] - x[:, 1]).mean()
    for rows in (100, 1000):
        net = network.fit_network(df, ["a", "b"], ["y"], "id", hidden=12, batch_rows=50, stages=((20, 1e-2),), shard_rows=rows)
        assert net.history[-1][0] < 0.3 * plain
    same = spark.createDataFrame([(1, 1.0, 2.0, 3.0)] * 500, "id long, a double, b double, y double")
    assert len(network.fit_network(same, ["a", "b"], ["y"], "id", stages=((2, 1e-2),), shard_rows=100).history) == 2


def _rings(n=260, seed=8):
    """Two classes a kernel of its own parts only, a third apart, and copies."""
    rng = np.random.default_rng(seed)
    angle, far = rng.uniform(0, 2 * np.pi, n), np.where(np.arange(n) % 2, 1.0, 1.6) + rng.normal(0, 0.12, n)
    x = np.c_[far * np.cos(angle), far * np.sin(angle)]
    label = np.arange(n) % 2
    x[-20:], label[-20:] = rng.normal(0, 0.3, (20, 2)) + 4, 2
    again = rng.integers(0, n, n // 4)
    return np.r_[x, x[again]], np.r_[label, label[again]]


def _dual(machine, x, y, cost, gamma):
    """Coefficients of the rows' places, and what the conditions are violated by."""
    at, count = np.unique(np.c_[x, y], axis=0, return_counts=True)
    x, y, c, beta = at[:, :-1], at[:, -1], cost * count, np.zeros(len(at))
    for r in machine.vectors.collect():
        for v, b in zip(np.array(r["x"]).reshape(-1, 2), r["beta"], strict=True):
            beta[np.flatnonzero((x == v).all(axis=1) & (y * b > 0))] += b
    assert abs(beta.sum()) < 1e-8 and (beta * y >= 0).all() and (beta * y <= c + 1e-9).all()
    v = y - kernel.kernel(x, x, gamma) @ beta
    up, down = (np.where(y > 0, beta < c, beta < 0), np.where(y > 0, beta > 0, beta > -c))
    return v[up].max() - v[down].min(), beta @ y - 0.5 * beta @ (y - v)


def test_svm_solves_the_kernels_dual_by_working_sets_too(spark):
    x, label = _rings()
    rows = spark.createDataFrame([(i, [float(v) for v in a], int(k)) for i, (a, k) in enumerate(zip(x, label, strict=True))], "id long, x array<double>, label int")
    whole = kernel.fit_pairs(rows, 3, 2, 5.0, 3.0)
    parts = kernel.fit_pairs(rows, 3, 2, 5.0, 3.0, local_rows=10, working=24, block_rows=37)
    assert max(p.steps for p in parts.pairs.values()) > 5
    for (a, b), p in whole.pairs.items():
        own = np.isin(label, (a, b))
        y = np.where(label[own] == b, 1.0, -1.0)
        found = [_dual(m.pairs[a, b], x[own], y, 5.0, 3.0) for m in (whole, parts)]
        assert all(gap < 1.1 * kernel.EPS for gap, _ in found)
        assert found[0][1] == pytest.approx(found[1][1], rel=1e-3)
        assert p.constant == pytest.approx(parts.pairs[a, b].constant, abs=0.02)
    given = [{r["id"]: r["values"] for r in kernel.decisions(m, rows, block_rows=50).collect()} for m in (whole, parts)]
    assert given[0].keys() == given[1].keys() == set(range(len(x)))
    assert max(np.abs(np.array(given[0][i]) - given[1][i]).max() for i in given[0]) < 0.02
    votes = np.array([given[0][i] for i in range(len(x))])
    assert ((votes[:, 0] > 0) == (label == 1))[label < 2].mean() > 0.97


def test_svm_with_a_class_missing(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)], "a double, k int").selectExpr("a", "double(k) AS label", "array(a) AS x")
    df = df.withColumn("features", models.array_to_vector("x"))
    pred = models.predict_svm_ovo(models.svm_ovo(df, 1), df)
    assert [r["prediction_label"] for r in pred.orderBy("a").collect()] == ["Lose", "Lose", "Draw", "Draw"]
    one = df.where("label = 1")
    assert {r["prediction_label"] for r in models.predict_svm_ovo(models.svm_ovo(one, 1), df).collect()} == {"Draw"}
    assert models.predict_svm_ovo(models.svm_ovo(one, 1), df.limit(0)).count() == 0


def test_grids_are_whole(monkeypatch):
    asked = {}
    monkeypatch.setattr(catalog, "outcome_data", lambda spark, sf_dir: (None, None, None))
    monkeypatch.setattr(models, "tune_boosted", lambda tr, grid, key, folds, rounds: asked.update(grid=grid, folds=folds, rounds=rounds))
    catalog.tune_boosted(None, None)
    assert np.prod([len(v) for v in asked["grid"].values()]) == 162 and (asked["folds"], asked["rounds"]) == (5, 1500)
    monkeypatch.setattr(models, "tune_svm", lambda tr, n, costs, gammas, key, folds: asked.update(points=len(costs) * len(gammas), svm_folds=folds))
    catalog.tune_svm(None, None)
    assert (asked["points"], asked["svm_folds"]) == (30, 10)


def test_a_grid_in_teams_is_the_grid(spark, monkeypatch):
    points = [boosting.Point(depth=d, step=s) for s in (0.1, 0.2, 0.3) for d in (5, 9)]
    found = boosting.teams(points, 5, 3, 9)
    assert sorted(i for t in found for i in t) == list(range(6)) and all(len({points[i].depth for i in t}) == 1 for t in found)
    assert [len(t) for t in found] == [3, 2, 1] and [len(t) for t in boosting.teams(points, 5, 3, 9, scores=30)] == [2, 1, 2, 1]
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(size=2)], float(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "fixture_id long, x array<double>, label double")
    df = df.withColumn("features", models.array_to_vector(models.F.transform("x", lambda v: v + models.F.col("label"))))
    grid = {"depth": [1, 2], "step": [0.3, 0.5]}
    one = models.tune_boosted(df, grid, "fixture_id", folds=2, rounds=3).collect()
    monkeypatch.setattr(models, "teams", lambda points, *a: [[i] for i in reversed(range(len(points)))])
    assert models.tune_boosted(df, grid, "fixture_id", folds=2, rounds=3).collect() == one and len(one) == 4


def test_ingest_and_refresh_leave_no_scratch(spark, tmp_path):
    import os

    from matchlake.session import scratch_dir
    from matchlake.sources import binding
    from matchlake.streaming import ingest, refresh

    top = scratch_dir(spark, "").removeprefix("file:")

    def left():
        return {n for n in os.listdir(top) if n.startswith(("ingest-", "refresh-"))}

    before, b = left(), binding.bronze_tables(spark, "/root/testdata/sf0.001")
    tables, changes = ({k: f"{tmp_path}/{k}/{what}" for k in ingest.KINDS} for what in ("bronze", "changes"))
    for kind in ingest.KINDS:
        catalog.payloads(b, kind).select("value").write.text(f"{tmp_path}/{kind}/raw")
        ingest.ingest_new(spark, f"{tmp_path}/{kind}/raw", kind, tables[kind], f"{tmp_path}/{kind}/checkpoint", changes=changes[kind])
        assert left() == before
    made = refresh.refresh(spark, tables, changes, f"{tmp_path}/gold")
    assert left() == before and refresh.gold_table(spark, f"{tmp_path}/gold", "gold_match_table").count() == made.recomputed["gold_match_table"] > 0


def test_passes_take_only_the_trees_since_scores_were_written():
    trees = [[boosting.Tree.empty(9)] for _ in range(30)]
    model = boosting.Boosted(boosting.Point(depth=9), 1, [np.zeros(63)] * 10, 9, trees)
    assert model.since(28).rounds == trees[28:] and not model.since(30).rounds and not model.since(0).edges
