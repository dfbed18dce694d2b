"""The pivot tree: exact at any depth, and sparse sends on clustered data."""

import numpy as np
import pytest

from matchlake.ml import neighbours


def _frames(spark, train, test):
    tr = spark.createDataFrame([(i, i % 3, list(map(float, v)), []) for i, v in enumerate(train)], "id long, label long, vec array<double>, folds array<int>").repartition(3)
    te = spark.createDataFrame([(10_000 + i, list(map(float, v)), -1, -1) for i, v in enumerate(test)], "id long, vec array<double>, rep int, fold int")
    return tr, te


def _brute(train, test, k):
    out = {}
    for i, v in enumerate(test):
        d = np.round(np.sqrt(((train - v) ** 2).sum(axis=1)), neighbours.DIGITS)
        out[10_000 + i] = [int(j) for j in np.lexsort((np.arange(len(train)), d))[:k]]
    return out


def _found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.test_id, r.rank)):
        out.setdefault(r.test_id, []).append(r.train_id)
    return out


@pytest.mark.parametrize("cell_rows,fan", [(40, 4), (25, 2)])
def test_tree_search_is_exact(spark, cell_rows, fan):
    rng = np.random.default_rng(cell_rows)
    train = np.concatenate([rng.normal(size=(120, 3)), np.repeat(rng.normal(size=(1, 3)), 60, axis=0)])  # a third are equal
    test = np.concatenate([rng.normal(size=(15, 3)), train[-1:]])
    got = _found(neighbours.nearest(*_frames(spark, train, test), 4, cell_rows, fan))
    assert got == _brute(train, test, 4)


def test_sends_fall_on_clustered_data(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 8)) * 20
    clustered = (centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 8)) * 0.1, centres[rng.integers(0, 30, 60)] + rng.normal(size=(60, 8)) * 0.1)
    uniform = (rng.normal(size=(900, 8)), rng.normal(size=(60, 8)))
    share = {}
    for name, (train, test) in (("clustered", clustered), ("uniform", uniform)):
        tr, te = _frames(spark, train, test)
        found, sends = neighbours.searched(tr, te, 3, 64, 16)
        leaves = neighbours._tree(tr, 64, 16)[0].select("cell", "part").distinct().count()
        share[name] = sends.count() / (60 * leaves)
        assert _found(neighbours._ranked(found, 3)) == _brute(train, test, 3)
    assert share["clustered"] < 0.1 < share["uniform"] <= 1, share
