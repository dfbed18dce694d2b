"""Steps whose cost grows with the table: what they shuffle, read and cache."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from matchlake.ml import features, models, network
from matchlake.operators import gold


@pytest.fixture()
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_team_rows_are_shuffled_once(spark, no_automatic_broadcast):
    matches = spark.createDataFrame([("1996-05-01", 1, 1996, 3, 4)] * 2 + [("1996-05-02", 2, 1996, 4, 3), (None, 3, 1996, 3, 4), ("1996-05-03", None, 1996, 4, 3)],
                                    "fixture_date string, fixture_id long, season long, away_team_id long, home_team_id long")
    standing = spark.createDataFrame([(1995, 3, 7), (1995, 4, 8)], "season long, team_id long, rank long")
    rows = gold.team_opponent_rows(matches, standing)
    assert exchanges(rows) - exchanges(gold.prior_standing(standing)) == 1
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, [
        (i, t, d, 1996, r) for i, d, away, home in ((1, "1996-05-01", 3, 4), (2, "1996-05-02", 4, 3), (3, None, 3, 4), (None, "1996-05-03", 4, 3))
        for t, r in ((home, {3: 7, 4: 8}[away]), (away, {3: 7, 4: 8}[home]))]))


def test_balancing_reads_its_rows_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def label(i):
        seen.add(1)
        return "abc"[min(i % 7, 2)]

    rows = spark.range(700).select("id", label("id").alias("y"))
    up = features.upsample(rows, "y", "id")
    assert up.groupBy("y").count().select("count").distinct().collect()[0][0] == 500
    assert seen.value <= 3 * 700


def test_folds_hold_only_what_the_fits_read(spark, monkeypatch):
    taken = []
    fit = CrossValidator.fit

    def watched(self, dataset, params=None):
        taken.append(dataset.columns)
        return fit(self, dataset, params)

    monkeypatch.setattr(CrossValidator, "fit", watched)
    rows = [(i, "text", Vectors.dense([float(i % 3), float(i % 5)]), float(i % 3)) for i in range(60)]
    d = spark.createDataFrame(rows, ["id", "note", "features", "label"])
    model = models.penalized_logit(d, 0.5, (1e-3, 1e-1), 2)
    assert taken == [["features", "label"]]
    assert models.predict_classes(model, d).where("prediction_label IS NOT NULL AND note = 'text'").count() == 60


def test_network_maps_whole_batches(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i % 3)) for i in range(50)] + [(50, None, 1.0)]
    d = spark.createDataFrame(rows, "id long, a double, y double")
    net = network.fit_network(d, ["a"], ["y"], "id", batches=2, stages=((1, 1e-2),))
    monkeypatch.setattr(network.F, "pandas_udf", lambda *a, **k: pytest.fail("an object for each row"))
    got = {r["id"]: r["pred_y"] for r in network.predict_network(net, d).collect()}
    assert got.pop(50) is None
    assert got == pytest.approx({i: float(net.outputs([[a]])[0, 0]) for i, a, _ in rows[:50]})
