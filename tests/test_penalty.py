"""Penalty path against Spark's own fit at one penalty, and its ends."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from matchlake.ml.penalty import penalty_path


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4)) * [1, 5, 0.2, 1] + [0, 3, 1, 0]
    score = np.c_[x[:, 0] * 1.5, np.zeros(400), -0.4 * x[:, 1] + 1] + rng.gumbel(size=(400, 3))
    rows = [(i, Vectors.dense([*v, 7.0]), float(y)) for i, (v, y) in enumerate(zip(x.tolist(), score.argmax(axis=1), strict=True))]
    return spark.createDataFrame([*rows, (400, None, 1.0), (401, rows[0][1], None)], SCHEMA).coalesce(2).cache()


def objective(x, y, b, penalty, alpha):
    score = x @ b[:, :-1].T + b[:, -1]
    loss = np.mean(np.log(np.exp(score).sum(axis=1)) - score[np.arange(len(y)), y])
    s = b[:, :-1] * x.std(axis=0, ddof=1)
    return loss + penalty * (alpha * np.abs(s).sum() + (1 - alpha) / 2 * (s * s).sum())


@pytest.mark.parametrize("alpha", [1.0, 0.5])
def test_one_penalty_is_as_good_as_sparks_fit(train, alpha):
    path = penalty_path(train, alpha, points=6, least=0.02, folds=0)
    assert np.all(path.coefficients[0][:, :-1] == 0) and np.any(path.coefficients[1][:, :-1] != 0)
    assert np.all(path.coefficients[:, :, 4] == 0)  # the constant feature
    known = train.where("label IS NOT NULL AND features IS NOT NULL")
    rows = known.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([int(r["label"]) for r in rows])
    for i in (2, 5):
        m = LogisticRegression(family="multinomial", elasticNetParam=alpha, regParam=float(path.penalties[i]), maxIter=500, tol=1e-10).fit(known)
        theirs = np.c_[m.coefficientMatrix.toArray(), m.interceptVector.toArray()]
        ours = objective(x, y, path.coefficients[i], path.penalties[i], alpha)
        assert ours <= objective(x, y, theirs, path.penalties[i], alpha) + 1e-7
        assert ours == pytest.approx(objective(x, y, theirs, path.penalties[i], alpha), abs=1e-4)


def test_path_of_fifty_with_folds(train):
    path = penalty_path(train, 1.0, folds=3, key="id")
    assert len(path.penalties) == 50 and np.all(np.diff(path.penalties) < 0)
    used = [(c[:, :-1] != 0).sum() for c in path.coefficients]
    assert used[0] == 0 and used[-1] > used[5] > 0
    assert path.held_out[path.best] < path.held_out[0] - 0.1 and 0 < path.best
    assert path.steps < 50 * 8
    p = train.where("features IS NOT NULL").select(*[c.alias(f"p{i}") for i, c in enumerate(path.probabilities(vector_to_array("features")))]).toPandas()
    assert np.allclose(p.sum(axis=1), 1)
