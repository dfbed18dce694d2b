"""Steps that were made to scale give what the plain ones give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.ml import boosting, models, neighbours
from matchlake.sources import raw
from matchlake.streaming import ingest


def walked(tree, bins, levels):
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        f = tree.feature[at]
        at = np.where(f >= 0, 2 * at + 1 + (bins[rows, f] > tree.cut[at]), at)
    return at


@pytest.mark.parametrize("depth", [1, 3, 6, 8])
def test_nodes_are_those_of_a_walk(depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, 64, (500, 5)).astype(np.int16)
    for leaves in (0.0, 0.3, 1.0):
        tree = boosting.Tree.empty(depth)
        inner = 2**depth - 1
        tree.feature[:inner] = np.where(rng.random(inner) < leaves, -1, rng.integers(0, 5, inner))
        tree.cut[:inner] = rng.integers(0, 63, inner)
        for levels in range(depth + 1):
            assert (tree.nodes(bins, levels) == walked(tree, bins, levels)).all()
    assert len(tree.nodes(bins[:0], depth)) == 0


def test_trees_are_passed_faster_than_walked():
    import time

    rng = np.random.default_rng(5)
    bins, tree = np.asfortranarray(rng.integers(0, 64, (200_000, 10)).astype(np.int16)), boosting.Tree.empty(4)
    tree.feature[:15], tree.cut[:15] = rng.integers(0, 10, 15), 31

    def seconds(f):
        best = np.inf
        for _ in range(3):
            t = time.perf_counter()
            f()
            best = min(best, time.perf_counter() - t)
        return best

    assert seconds(lambda: tree.nodes(bins, 4)) < seconds(lambda: walked(tree, bins, 4)) / 2


def test_cells_beyond_the_half_way_plane_hold_nothing_near():
    rng = np.random.default_rng(1)
    pivots, members, asked = rng.normal(size=(12, 6)), rng.normal(size=(3000, 6)), rng.normal(size=(200, 6))
    pivots[3] = pivots[2]  # a plane that does not exist
    home = neighbours._distances(members, pivots).argmin(axis=1)
    radii = np.array([neighbours._distances(members[home == j], pivots[j:j + 1]).max(initial=0) for j in range(12)])
    d = neighbours._distances(asked, pivots)
    least = neighbours._beyond(d, neighbours._distances(pivots, pivots), radii)
    true = np.stack([neighbours._distances(asked, members[home == j]).min(axis=1, initial=np.inf) for j in range(12)], axis=1)
    assert (least <= true + 1e-9).all()
    near = true.min(axis=1, keepdims=True)
    assert (least <= near).sum() < (d - radii <= near).sum() / 2


def test_far_vectors_are_not_ruled_out_by_overflow():
    d = np.array([[1e200, 2e200, np.inf]])
    gaps = np.array([[0, 1e200, np.inf], [1e200, 0, np.inf], [np.inf, np.inf, 0]])
    assert (neighbours._beyond(d, gaps, np.zeros(3)) == d).all()


def test_statistics_are_moved_without_their_names(spark, tmp_path):
    stat = spark.createDataFrame([(1, 8, "3", "5%", None, "1", "2", "3", "4"), (1, 7, "9", "1%", "2", "0", "2", "9", "1"), (1, 7, "8", "1%", "2", "0", "2", "9", "1")],
                                 "fixture_id long, team_id long, total_shots string, possession string, red_cards string, gk_saves string, fouls string, tot_passes string, a_passes string")
    dates = spark.createDataFrame([(1, "1995-02-03")], "fixture_id long, fixture_date string")
    lines = raw.stat_payloads(stat, dates)
    plan = lines._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [i for i, x in enumerate(plan) if "Aggregate" in x or "Exchange" in x]
    assert not any("Shots on Goal" in plan[i] for i in below)
    path = f"{tmp_path}/landed"
    rows = raw.stat_rows(stat, dates).withColumn("month", F.substring("date", 1, 7))
    raw.land(rows, path, ["month"], lines=lambda x: raw.stat_lines(x, "month"))
    assert [r["value"] for r in spark.read.text(path).collect()] == [lines.first()["value"]]
    back = raw.bronze_fixture_stat(raw.read_raw(spark, path, "fixture-stats"))
    assert [tuple(r) for r in back.select(*stat.columns).collect()] == [(1, 7, "8", "1%", "2", "0", "2", "9", "1"), (1, 7, "9", "1%", "2", "0", "2", "9", "1"), (1, 8, "3", "5%", None, "1", "2", "3", "4")]


def test_a_batch_is_merged_in_one_shuffle(spark):
    rows = spark.createDataFrame([(1, "a", "p1", 5, "f", True)], "k long, v string, _part string, _arrived long, _file string, _current boolean")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ingest._merged(rows, ("k",))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1


def test_fits_of_a_grid_run_side_by_side(spark):
    import threading

    both = threading.Barrier(2, timeout=60)  # breaks if the fits come one after the other

    def measure(tr, te, point):
        both.wait()
        return point["cost"] + te.count()

    df = spark.createDataFrame([(i,) for i in range(20)], "id long")
    found = models._tuned(df, {"cost": [1.0, 2.0]}, "id", 2, measure, "cost double, fold int, accuracy double").collect()
    assert [(r["cost"], r["fold"]) for r in found] == [(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)]
    assert sum(r["accuracy"] for r in found) == 46.0
