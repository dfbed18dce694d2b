"""Outcome classifiers and the score regressor as Spark ML jobs.

Every fit is a distributed Spark ML estimator (or an aggregate whose result
is a p x p matrix); nothing is pulled to pandas.  Outcome levels are
Lose < Draw < Win (home-team view); predictions come back as
``prediction_label`` text next to ``actual``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.scalar import OUTCOME_LEVELS, class_from_probs
from matchlake.ml.boosting import Boosted, Point, bin_edges, boost, probabilities, teams
from matchlake.ml.features import bucket100
from matchlake.ml.kernel import Machine, decisions, fit_pairs
from matchlake.ml.neighbours import knn, knn_cv  # noqa: F401
from matchlake.ml.ordinal import OrderedLogit, fit_ordered
from matchlake.ml.sums import gramian, matrix
from matchlake.session import drop_scratch, scratch_dir

LABEL = "label"


def label_index(df: DataFrame, col: str, levels: Sequence[str] = OUTCOME_LEVELS) -> DataFrame:
    """Fixed level order (Lose=0, Draw=1, Win=2) -- the factor code minus one."""
    m = StringIndexerModel.from_labels(list(levels), inputCol=col, outputCol=LABEL, handleInvalid="skip")
    return m.transform(df)


def _level_of(idx: Column, levels: Sequence[str] = OUTCOME_LEVELS) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in levels]), idx.cast("int") + 1)


def prepare(df: DataFrame, features: Sequence[str], label_col: str) -> DataFrame:
    v = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(df)
    return label_index(v, label_col)


def _from_probability(pred: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    return pred.withColumn("prediction_label", class_from_probs(p[0], p[1], p[2]))


# ---------------------------------------------------------------- linear models

def multinomial_logit(train: DataFrame, max_iter: int = 250, reg: float = 0.0, alpha: float = 0.0):
    return LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg,
                              elasticNetParam=alpha, featuresCol="features", labelCol=LABEL).fit(train)


def predict_classes(model, test: DataFrame) -> DataFrame:
    return _from_probability(model.transform(test))


def penalized_logit(train: DataFrame, alpha: float, reg_grid: Sequence[float] = (1e-4, 1e-3, 1e-2, 1e-1),
                    folds: int = 10, seed: int = 123, parallelism: int = 4):
    """Lasso (alpha=1) / elastic net (alpha=0.5) multinomial logit with the
    penalty chosen by k-fold CV (the best mean score, like ``lambda.min``)."""
    lr = LogisticRegression(family="multinomial", elasticNetParam=alpha, maxIter=250,
                            featuresCol="features", labelCol=LABEL)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_grid)).build()
    ev = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="logLoss")
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                        seed=seed, parallelism=parallelism)
    return cv.fit(train.select("features", LABEL)).bestModel  # each fold is cached: no column more than the fits read


def ordered_logit(train: DataFrame, max_iter: int = 250) -> OrderedLogit:
    """Proportional-odds logit: one slope vector, ordered intercepts."""
    return fit_ordered(train, max_iter, label=LABEL, levels=len(OUTCOME_LEVELS))


def predict_ordered(model: OrderedLogit, test: DataFrame) -> DataFrame:
    """Class probabilities; none is negative, as the cumulative curves are parallel."""
    shares = model.probabilities(vector_to_array("features"))
    x = test.withColumns({f"p_{lv.lower()}": p for lv, p in zip(OUTCOME_LEVELS, shares, strict=True)})
    return x.withColumn("prediction_label", class_from_probs("p_lose", "p_draw", "p_win"))


# ---------------------------------------------------------------- trees

def random_forest(train: DataFrame, trees: int = 500, seed: int = 123):
    return RandomForestClassifier(numTrees=trees, seed=seed, featuresCol="features", labelCol=LABEL).fit(train)


def validation_rows(key: str, percent: int = 10) -> Column:
    """A fixed share of the rows by the hash of a key: copies of a row stay together."""
    return bucket100(key) < percent


def _boosting_rows(train: DataFrame, key: str | None, fold: Column) -> DataFrame:
    named = F.xxhash64(key) if key else F.xxhash64("features")
    return train.where(F.col(LABEL).isNotNull()).select(named.alias("h"), fold.cast("int").alias("fold"), vector_to_array("features").alias("x"), F.col(LABEL).cast("int").alias("y"))


def fit_boosted(train: DataFrame, step: float = 0.01, rounds: int = 2500, depth: int = 6,
                subsample: float = 1.0, seed: int = 123, key: str | None = None, patience: int = 10, **params) -> Boosted:
    """Multiclass boosted trees (softmax loss, one model for all classes).

    With a ``key``, a model without the validation rows (by the key's hash) grows beside the
    one on all rows; when its loss on them has not fallen for ``patience`` rounds both end, and
    the result has as many rounds as its least loss.  The losses are the result's ``losses``.
    Without a key there is no validation, and rows are named by their features' hash.
    """
    point = Point(step=step, depth=depth, subsample=subsample, **params)
    fold = validation_rows(key).cast("int") if key else F.lit(0)
    rows = _boosting_rows(train, key, fold)
    if not key:
        return boost(rows, [(point, -1)], classes=len(OUTCOME_LEVELS), rounds=rounds, seed=seed)[0]
    part, whole = boost(rows, [(point, 1), (point, -1)], classes=len(OUTCOME_LEVELS), rounds=rounds, patience=patience, seed=seed, group=lambda m: "one")
    best = part.best if part.losses else len(whole.rounds)
    whole.losses = part.losses
    return whole.cut_to(best)


def predict_boosted(model: Boosted, test: DataFrame) -> DataFrame:
    x = test.withColumn("__p", probabilities(model, vector_to_array("features")))
    x = x.select("*", *[F.col("__p")[i].alias(f"p_{lv.lower()}") for i, lv in enumerate(OUTCOME_LEVELS)]).drop("__p")
    return x.withColumn("prediction_label", class_from_probs("p_lose", "p_draw", "p_win"))


def log_loss(pred: DataFrame) -> float:
    """Mean negative log of the true class's probability (p_lose, p_draw, p_win)."""
    p = F.element_at(F.array("p_lose", "p_draw", "p_win"), F.col(LABEL).cast("int") + 1)
    return pred.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15))))).first()[0]


FITS_AT_ONCE = 4


def _tuned(train: DataFrame, grid: dict[str, Sequence], key: str, folds: int, measure, columns: str) -> DataFrame:
    """A row for each point of the grid and fold; folds are by the hash of ``key``.  Fits are rounds
    of short jobs that leave cores idle: FITS_AT_ONCE of them run side by side."""
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    fold = bucket100(key) % folds

    def row(point: dict, f: int) -> tuple:
        return (*point.values(), f, float(measure(train.where(fold != f), train.where(fold == f), point)))

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:  # a point's fits are Spark jobs; the grid is the caller's
        running = [pool.submit(inheritable_thread_target(train.sparkSession)(row), point, f) for point in points for f in range(folds)]
        rows = [job.result() for job in running]
    return train.sparkSession.createDataFrame(rows, columns)


def tune_boosted(train: DataFrame, grid: dict[str, Sequence], key: str, folds: int = 5, rounds: int = 1500, patience: int = 10, seed: int = 123) -> DataFrame:
    """Least mean log-loss over the folds, and the rounds that give it, for each point of
    ``grid`` (the fields of ``Point``): points with a positive score only, best first.

    Points of a team (``boosting.teams``) and their folds grow in the same passes over the rows, so that a task's histograms and a
    row's scores stay bounded whatever the grid; FITS_AT_ONCE teams run side by side.
    """
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    spark, classes = train.sparkSession, len(OUTCOME_LEVELS)
    folder = scratch_dir(spark, f"tuned-{uuid.uuid4().hex}")
    data = _boosting_rows(train, key, bucket100(key) % folds)
    data.write.parquet(folder)
    data = spark.read.schema(data.schema).parquet(folder)
    first = data.select(F.size("x").alias("n")).first()
    width = first["n"] if first else 0
    edges = bin_edges(data, width) if first else None
    grown: list[list[Boosted]] = [[] for _ in points]

    def grow(team: list[int]) -> None:
        jobs = [(Point(**points[i]), f) for i in team for f in range(folds)]
        found = boost(data, jobs, classes=classes, rounds=rounds, patience=patience, seed=seed, group=lambda m: m // folds, edges=edges)
        for place, i in enumerate(team):
            grown[i] = found[place * folds:(place + 1) * folds]

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(grow), team) for team in teams([Point(**p) for p in points], folds, classes, width)]
        for job in running:
            job.result()
    drop_scratch(spark, folder)
    rows = []
    for i, point in enumerate(points):
        scored = [m.losses for m in grown[i] if m.losses]
        if scored:
            mean = np.mean(scored, axis=0)
            rows.append((*point.values(), int(np.argmin(mean)), float(mean.min())))
    names = {k: ("double" if any(isinstance(v, float) for v in vs) else "long") for k, vs in grid.items()}
    table = train.sparkSession.createDataFrame(rows, ", ".join(f"{k} {t}" for k, t in names.items()) + ", rounds int, score double")
    return table.where("score > 0").orderBy("score", *grid)


def tune_svm(train: DataFrame, n_in: int, costs: Sequence[float], gammas: Sequence[float], key: str, folds: int = 10) -> DataFrame:
    """Accuracy of the kernel SVM for each cost and gamma, best first."""
    def measure(tr, te, point):
        pred = predict_svm_ovo(svm_ovo(tr, n_in, **point), te)
        return pred.agg(F.avg((F.col("prediction_label") == _level_of(F.col(LABEL))).cast("double"))).first()[0]

    table = _tuned(train, {"cost": costs, "gamma": gammas}, key, folds, measure, "cost double, gamma double, fold int, accuracy double")
    return table.groupBy("cost", "gamma").agg(F.avg("accuracy").alias("accuracy")).orderBy(F.desc("accuracy"), "cost", "gamma")


def importances(model, names: Sequence[str]) -> DataFrame:
    """A forest's feature importances, largest first."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# ---------------------------------------------------------------- kernel SVM

def fourier_features(df: DataFrame, n_in: int, dim: int = 200, gamma: float = 0.1, seed: int = 123,
                     inp: str = "features", out: str = "rff") -> DataFrame:
    """Random Fourier features for the RBF kernel exp(-gamma |x-y|^2)
    (Rahimi & Recht, 2007): sqrt(2/D) cos(W x + b).  W and b are model
    parameters (dim x n_in), broadcast with the closure; rows are mapped as matrices of
    whole Arrow batches, without an object for each row."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_in, dim))
    b = rng.uniform(0.0, 2 * np.pi, size=dim)
    scale = np.sqrt(2.0 / dim)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def rff(x: pa.Array) -> pa.Array:
        z = scale * np.cos(matrix(x, n_in) @ w + b)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, dim, dtype=np.int32)), pa.array(z.ravel()))

    return df.withColumn(out, array_to_vector(rff(vector_to_array(inp))))


def svm_ovo(train: DataFrame, n_in: int, cost: float = 1.0, gamma: float = 0.1) -> Machine:
    """One-vs-one machines with the radial kernel, each solved in the dual to the usual tolerance."""
    return fit_pairs(train.select(vector_to_array("features").alias("x"), F.col(LABEL).alias("label")), len(OUTCOME_LEVELS), n_in, cost, gamma)


def predict_svm_ovo(machine: Machine, test: DataFrame) -> DataFrame:
    """Majority vote of the pairwise machines (ties -> lower level)."""
    rows = test.withColumn("__id", F.monotonically_increasing_id())
    path = f"{scratch_dir(test.sparkSession, 'svm-' + uuid.uuid4().hex)}/rows"
    rows.write.parquet(path)
    rows = test.sparkSession.read.schema(rows.schema).parquet(path)
    found = decisions(machine, rows.select(F.col("__id").alias("id"), vector_to_array("features").alias("x")))
    votes = [F.lit(0) for _ in OUTCOME_LEVELS]
    for i, (a, b) in enumerate(machine.pairs):
        v = F.col("values")[i]
        votes[a] = votes[a] + (v < 0).cast("int")
        votes[b] = votes[b] + (v > 0).cast("int")
    best = F.array_position(F.array(*votes), F.array_max(F.array(*votes))) - 1
    found = found.select(F.col("id").alias("__id"), _level_of(best).alias("prediction_label"))
    return rows.join(found, "__id").drop("__id")


# ---------------------------------------------------------------- linear discriminant analysis

def lda_statistics(train: DataFrame, features: Sequence[str], label_col: str = LABEL) -> DataFrame:
    """Class sizes and means: a row for each class, from one grouped aggregate of
    the feature vectors."""
    v = VectorAssembler(inputCols=list(features), outputCol="__f", handleInvalid="skip").transform(train.where(F.col(label_col).isNotNull()))
    return v.groupBy(label_col).agg(Summarizer.metrics("mean", "count").summary(F.col("__f")).alias("s")) \
        .select(F.col(label_col).alias("label"), F.col("s.count").alias("n"), vector_to_array("s.mean").alias("mean"))


def lda_fit(train: DataFrame, features: Sequence[str], label_col: str = LABEL) -> dict:
    """Class means, priors and pooled covariance.  The means are one grouped
    aggregate; the covariance is the Gramian of the rows centred by their class's mean
    (p x p, as is the model, which is solved on the driver)."""
    fs = list(features)
    stats = sorted(lda_statistics(train, fs, label_col).collect(), key=lambda r: str(r["label"]))
    n_tot, k = sum(r["n"] for r in stats), len(stats)
    labels, means = [r["label"] for r in stats], [np.array(r["mean"]) for r in stats]
    priors = [r["n"] / n_tot for r in stats]
    centre = F.create_map(*[x for r in stats for x in (F.lit(r["label"]), F.array(*[F.lit(float(v)) for v in r["mean"]]))])
    rows = train.where(F.col(label_col).isNotNull()).dropna(subset=fs)
    c = centre[F.col(label_col)]
    centred = rows.select(*[(F.col(f).cast("double") - c[i]).alias(f"f{i}") for i, f in enumerate(fs)])
    cov = gramian(centred, centred.columns)[3] / max(n_tot - k, 1)
    inv = np.linalg.pinv(cov)
    coefs = [inv @ mu for mu in means]
    consts = [float(-0.5 * mu @ inv @ mu + np.log(pi)) for mu, pi in zip(means, priors)]
    return {"features": fs, "labels": labels, "coef": coefs, "const": consts, "means": means, "priors": priors, "cov": cov}


def predict_lda(model: dict, test: DataFrame) -> DataFrame:
    """Discriminant scores as plain column arithmetic (stays in codegen)."""
    scores = []
    for lab, w, c in zip(model["labels"], model["coef"], model["const"]):
        s = F.lit(c)
        for f, wi in zip(model["features"], w):
            s = s + F.lit(float(wi)) * F.col(f)
        scores.append(F.struct(s.alias("score"), F.lit(lab).alias("lab")))
    best = F.array_max(F.array(*scores))["lab"]
    return test.withColumn("lda_label", best)


# ---------------------------------------------------------------- score model

def fit_scores(train: DataFrame, features: Sequence[str], targets=("away_goals", "home_goals"),
               rounds: int = 50, step: float = 0.1, seed: int = 123):
    """Two-output goals regressor under absolute loss: one GBT per target in
    one pipeline."""
    # index columns are numeric inputs here (as in the reference's network),
    # not categorical splits: drop the nominal metadata the indexer attached
    train = train.select(*[F.col(c).alias(c, metadata={}) if c in features else F.col(c) for c in train.columns])
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")]
    for t in targets:
        stages.append(GBTRegressor(featuresCol="features", labelCol=t, predictionCol=f"pred_{t}",
                                   lossType="absolute", maxIter=rounds, stepSize=step, seed=seed))
    return Pipeline(stages=stages).fit(train)


# ---------------------------------------------------------------- history and formula

def boosting_history(model: Boosted) -> DataFrame:
    """Validation loss after each round: round, metric."""
    return SparkSession.active().createDataFrame([(r, float(v)) for r, v in enumerate(model.losses) if r], "round int, metric double")


def score_history(model, df: DataFrame, targets=("away_goals", "home_goals")) -> DataFrame:
    """Mean absolute error on ``df`` after each round of the score model, by target."""
    x = model.stages[0].transform(df)
    rows = [(t, r + 1, float(v)) for t, m in zip(targets, model.stages[1:], strict=True)
            for r, v in enumerate(m.evaluateEachIteration(x, "absolute"))]
    return df.sparkSession.createDataFrame(rows, "target string, round int, metric double")


def formula_frame(df: DataFrame, label: str, predictors: Sequence[str]) -> DataFrame:
    """``label ~ a + b + ...`` through RFormula (strings are one-hot encoded)."""
    from pyspark.ml.feature import RFormula
    f = RFormula(formula=f"{label} ~ " + " + ".join(predictors), featuresCol="features", labelCol=LABEL)
    return f.fit(df).transform(df)
