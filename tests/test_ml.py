"""Invariants of features, evaluation and models."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from matchlake.ml import evaluate, features, models


def test_upsample_balanced(spark):
    rows = [(i, "a" if i % 10 < 6 else ("b" if i % 10 < 9 else "c")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y string")
    up = features.upsample(df, "y", "id")
    counts = {r.y: r.n for r in up.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"a": 300, "b": 300, "c": 300}
    # every original row kept at least once
    assert up.select("id").distinct().count() == 500


def test_rank_in_class_is_exact(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(2000)], "id long, c long")
    r = features.rank_in_class(df, "c", "id", bits=4)
    for c in range(3):
        ranks = sorted(x[0] for x in r.where(F.col("c") == c).select("__rank").collect())
        assert ranks == list(range(1, len(ranks) + 1))


def test_confusion_total_and_accuracy(spark):
    df = spark.createDataFrame([("Win", "Win"), ("Win", "Lose"), ("Draw", "Draw"), ("Lose", "Lose")],
                               "a string, p string")
    c = evaluate.confusion(df, "a", "p")
    assert c.count() == 9 and sum(r.n for r in c.collect()) == 4
    assert evaluate.accuracy(df, "a", "p").first().accuracy == 0.75


def test_pca_shares_sum_to_one(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(200, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    t = features.pca_variance(df, ["a", "b", "c", "d"]).collect()
    assert abs(sum(r.share for r in t) - 1.0) < 1e-9
    assert features.pca_keep([0.5, 0.3, 0.19, 0.01], 0.99) == 2


def _separable(spark, n=300):
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(n):
        lab = ["Lose", "Draw", "Win"][i % 3]
        ctr = {"Lose": -4.0, "Draw": 0.0, "Win": 4.0}[lab]
        rows.append((i, lab, float(ctr + rnd.normal()), float(rnd.normal())))
    df = spark.createDataFrame(rows, "id long, outcome string, f1 double, f2 double")
    return models.prepare(df, ["f1", "f2"], "outcome")


def test_models_beat_majority_on_separable(spark):
    d = _separable(spark)
    m = models.multinomial_logit(d)
    p = models.predict_classes(m, d)
    assert evaluate.accuracy(p, "outcome", "prediction_label").first().accuracy > 0.9
    probs = p.select(models.vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r.p) - 1) < 1e-9 for r in probs)
    po = models.predict_ordered(models.ordered_logit(d), d)
    assert evaluate.accuracy(po, "outcome", "prediction_label").first().accuracy > 0.9
    lda = models.predict_lda(models.lda_fit(d, ["f1", "f2"], "outcome"), d)
    assert evaluate.accuracy(lda, "outcome", "lda_label").first().accuracy > 0.9
    sv = models.predict_svm_ovo(models.svm_ovo(d, n_in=2, gamma=0.05), d)
    assert evaluate.accuracy(sv, "outcome", "prediction_label").first().accuracy > 0.8


def test_knn_matches_brute_force(spark):
    rnd = np.random.default_rng(5)
    tr = rnd.normal(size=(120, 5))
    te = rnd.normal(size=(30, 5))
    lab = rnd.integers(0, 3, size=120)
    train = spark.createDataFrame([(i, list(map(float, v)), int(lab[i])) for i, v in enumerate(tr)],
                                  "id long, vec array<double>, label long").repartition(3)
    test = spark.createDataFrame([(1000 + i, list(map(float, v))) for i, v in enumerate(te)],
                                 "id long, vec array<double>")
    got = {r.id: r.knn_label for r in models.knn(train, test, k=5).collect()}
    for i, v in enumerate(te):
        d = np.round(np.sqrt(((tr - v) ** 2).sum(axis=1)), 9)
        order = sorted(range(len(tr)), key=lambda j: (d[j], j))[:5]
        votes = {}
        for rank, j in enumerate(order):
            c, first = votes.get(lab[j], (0, rank))
            votes[lab[j]] = (c + 1, first)
        best = sorted(votes.items(), key=lambda kv: (-kv[1][0], kv[1][1]))[0][0]
        assert got[1000 + i] == best
    # same answer when cells are cut into parts of a few rows
    got2 = {r.id: r.knn_label for r in models.knn(train, test, k=5, cell_rows=30).collect()}
    assert got2 == got


@pytest.mark.parametrize("partitions,batch,cell_rows", [(1, 10000, 4096), (7, 10, 30)])
def test_knn_ties_go_to_the_smaller_ids(spark, partitions, batch, cell_rows):
    """200 equal vectors: the five smallest ids vote, however rows are dealt."""
    train = spark.createDataFrame([(i, [1.0, 2.0], int(i >= 5)) for i in range(200)], "id long, vec array<double>, label long").repartition(partitions)
    test = spark.createDataFrame([(1000, [1.0, 2.0]), (1001, [3.0, 0.0])], "id long, vec array<double>")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        got = {r.id: r.knn_label for r in models.knn(train, test, k=5, cell_rows=cell_rows).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {1000: 0, 1001: 0}


def test_knn_cv_matches_brute_force(spark):
    import hashlib
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=(90, 3))
    lab = rnd.integers(0, 3, size=90)
    df = spark.createDataFrame([(i, list(map(float, v)), int(lab[i])) for i, v in enumerate(x)],
                               "id long, vec array<double>, label long").repartition(2)
    got = {r.k: r.accuracy for r in models.knn_cv(df, ks=[1, 3, 5], folds=3, repeats=2).collect()}
    exp = {}
    for k in (1, 3, 5):
        hits = []
        for r in range(2):
            fold = [int(hashlib.md5(f"{i}|{r}".encode()).hexdigest()[:8], 16) % 3 for i in range(90)]
            for i in range(90):
                cand = [j for j in range(90) if fold[j] != fold[i]]
                d = {j: round(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), 9) for j in cand}
                nb = sorted(cand, key=lambda j: (d[j], j))[:k]
                votes = {}
                for rank, j in enumerate(nb):
                    c, first = votes.get(lab[j], (0, rank))
                    votes[lab[j]] = (c + 1, first)
                pred = sorted(votes.items(), key=lambda kv: (-kv[1][0], kv[1][1]))[0][0]
                hits.append(pred == lab[i])
        exp[k] = sum(hits) / len(hits)
    assert got.keys() == exp.keys()
    for k in exp:
        assert abs(got[k] - exp[k]) < 1e-12


def test_scaling_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "id long, x double")
    z = {r.id: r.z_x for r in features.standardize(df, ["x"]).collect()}
    assert z[3] is None and abs(z[1] + z[2]) < 1e-12 and abs(z[2] - 2 ** -0.5) < 1e-12


def _blobs(spark, n=240):
    rnd = np.random.default_rng(7)
    rows = []
    for i in range(n):
        k = i % 3
        rows.append((i, ["Lose", "Draw", "Win"][k], float(3 * k + rnd.normal()), float(rnd.normal()), float(-3 * k + rnd.normal()), i % 5, i % 4))
    return spark.createDataFrame(rows, "fixture_id long, outcome string, f1 double, f2 double, f3 double, home_team_id int, away_team_id int").cache()


def test_pca_scores_match_numpy(spark):
    d = _blobs(spark)
    cols = ["f1", "f2", "f3"]
    tr, te = d.where("fixture_id < 200"), d.where("fixture_id >= 200")
    a, b, names = features.pca_frame(tr, te, cols, share=0.999)
    x = np.array(tr.orderBy("fixture_id").select(*cols).collect())
    y = np.array(te.orderBy("fixture_id").select(*cols).collect())
    mean, std = x.mean(0), x.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(((x - mean) / std).T))
    vectors = vectors[:, np.argsort(-values)][:, :len(names)]
    for frame, raw in ((a, x), (b, y)):
        got = np.abs(np.array(frame.orderBy("fixture_id").select(*names).collect()))
        assert np.allclose(got, np.abs((raw - mean) / std @ vectors), atol=1e-8)
    p, q = features.bind_effects(a, b, names)
    first = p.orderBy("fixture_id").first()["features"].toArray()
    assert len(first) == len(names) + 5 + 4 and p.count() == 200 and q.count() == 40


def test_lda_covariance_matches_numpy(spark):
    d = _blobs(spark)
    fit = models.lda_fit(d, ["f1", "f2", "f3"], "outcome")
    x = np.array(d.orderBy("fixture_id").select("f1", "f2", "f3").collect())
    pooled = sum(np.cov(x[k::3].T) * (len(x[k::3]) - 1) for k in range(3)) / (len(x) - 3)
    assert np.allclose(fit["cov"], pooled, atol=1e-8)


def test_boosted_fit_and_history(spark):
    d = models.prepare(_blobs(spark), ["f1", "f2", "f3"], "outcome")
    m = models.fit_boosted(d, step=0.3, rounds=8, depth=2, key="fixture_id")
    pred = models.predict_boosted(m, d)
    assert {r[0] for r in pred.select("prediction_label").distinct().collect()} == {"Lose", "Draw", "Win"}
    assert evaluate.accuracy(pred, "outcome", "prediction_label").first().accuracy > 0.8
    best = evaluate.best_round(models.boosting_history(m)).collect()
    assert len(best) == 1 and 1 <= best[0].best_round <= best[0].rounds == 8


def test_svm_predicts_all_classes(spark):
    d = models.prepare(features.standardize(_blobs(spark), ["f1", "f2", "f3"]), ["z_f1", "z_f2", "z_f3"], "outcome")
    pred = models.predict_svm_ovo(models.svm_ovo(d, n_in=3, gamma=0.1), d)
    assert pred.select("prediction_label").distinct().count() == 3
    assert evaluate.accuracy(pred, "outcome", "prediction_label").first().accuracy > 0.8


def test_importances_are_ordered(spark):
    d = models.prepare(_blobs(spark), ["f1", "f2", "f3"], "outcome")
    rows = models.importances(models.random_forest(d, trees=10), ["f1", "f2", "f3"]).collect()
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True) and rows[-1].feature == "f2"


def test_fourier_features_are_those_of_the_formula(spark):
    x = np.random.default_rng(5).normal(size=(37, 3))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["i", "features"])
    got = models.fourier_features(df.repartition(50), 3, dim=8, gamma=0.5, seed=9).orderBy("i").collect()
    rng = np.random.default_rng(9)
    w, b = rng.normal(0.0, 1.0, size=(3, 8)), rng.uniform(0.0, 2 * np.pi, size=8)
    assert np.allclose(np.array([r.rff.toArray() for r in got]), 0.5 * np.cos(x @ w + b), atol=1e-12)
