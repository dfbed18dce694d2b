"""Feature preparation as distributed Spark jobs.

Nothing here funnels data through the driver or through one task: category
indexes come from ``StringIndexer`` (the fitted label list is the model and
is as small as the category domain); balancing ranks rows inside a class
with a two-level hash histogram instead of a one-key window (a class may hold
a third of all rows); splits are hash-based and reproducible.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.ranking import global_index
from matchlake.functions.scalar import OUTCOME_LEVELS
from matchlake.ml.sums import correlations
from matchlake.operators.joins import small_side
from matchlake.session import scratch_dir

# Column names of the match table that the score model drops before
# training, its categorical columns, its targets, and the classifiers' features.
MODEL_DROP = ["fixture_date", "fixture_id", "referee", "venue_id", "status", "away_team_id",
              "home_team_id", "match_result", "coach_id_home", "coach_id_away", "league_id", "season"]
CATEGORICAL = ["coach_id_home", "league_id", "season", "coach_id_away"]
RATIO_FEATURES = ["rank_team_faced_away", "rank_team_faced_home", "total_shots_r", "prior_season_rank",
                  "possession_r", "red_cards_away", "red_cards_home", "gk_saves_r", "fouls_r",
                  "pass_accuracy_r"]


# ---------------------------------------------------------------- team profile

def team_profile(players: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric by team and season (NULLs are left out of a mean)."""
    return players.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in metrics])


# ---------------------------------------------------------------- selection helpers

def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from ``first`` to ``last`` inclusive, in table order."""
    cols = df.columns
    return df.select(*cols[cols.index(first): cols.index(last) + 1])


def select_prefix(df: DataFrame, prefix: str, exclude: bool = False) -> DataFrame:
    keep = [c for c in df.columns if c.startswith(prefix) != exclude]
    return df.select(*keep)


def select_from(df: DataFrame, k: int) -> DataFrame:
    """Drop the first ``k`` columns (positional slice)."""
    return df.select(*df.columns[k:])


# ---------------------------------------------------------------- encoding

def index_categories(df: DataFrame, cols: Sequence[str] = CATEGORICAL, suffix: str = "Index") -> DataFrame:
    """Label-encode: most frequent value -> 0, ties by the text value.  One
    indexer fits all columns in a single pass."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                        stringOrderType="frequencyDesc", handleInvalid="keep")
    return idx.fit(df).transform(df)


def outcome(match_result: str = "match_result") -> Column:
    """Home-team view of the result as the classifiers' levels."""
    r = F.col(match_result)
    return F.when(r == "Home", F.lit("Win")).when(r == "Away", F.lit("Lose")).otherwise(F.lit("Draw"))


def model_frame(gold_match: DataFrame, keep_id: bool = False) -> DataFrame:
    """Score-model input: index the 4 categoricals, drop 12 columns, drop rows
    with any NULL -> 14 features + 2 targets."""
    x = index_categories(gold_match)
    drop = [c for c in MODEL_DROP if not (keep_id and c == "fixture_id")]
    return x.drop(*drop).dropna()


def fixed_effects(df: DataFrame, home: str = "home_team_id", away: str = "away_team_id",
                  out: str = "match_combo") -> DataFrame:
    """One dummy per (home, away) pairing, as a sparse one-hot vector.  Pairings are
    as many as the square of the teams, so they are numbered (by frequency, then by
    text) in a table that is joined back, not in a fitted label list."""
    x = df.withColumn(out, F.concat_ws("_", F.col(home).cast("string"), F.col(away).cast("string")))
    counts = x.groupBy(out).agg(F.count(F.lit(1)).alias("__n"))
    index = global_index(counts, [F.desc("__n"), F.asc(out)], out + "_index").drop("__n")
    x = x.join(index.withColumn(out + "_index", F.col(out + "_index").cast("double")), out)
    return OneHotEncoder(inputCols=[out + "_index"], outputCols=[out + "_vec"], dropLast=False).fit(x).transform(x)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation of each column (one aggregate)."""
    r = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return {c: (r[f"m{i}"] or 0.0, r[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def apply_scale(df: DataFrame, scale: dict[str, tuple[float, float]], prefix: str = "z_") -> DataFrame:
    """Centred and scaled columns beside the others; a NULL stays NULL."""
    return df.select("*", *[((F.col(c) - m) / s).alias(prefix + c) for c, (m, s) in scale.items()])


def standardize(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Centre and scale (sample standard deviation, like R's ``scale``)."""
    return apply_scale(df, fit_scale(df, cols), prefix)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair as a long table, over the rows where both are
    known.  Two aggregates of block products, whatever the number of columns;
    NULL where a column does not vary."""
    cols = list(cols)
    corr = correlations(df, cols)
    rows = [(a, b, None if np.isnan(corr[i, j]) else float(corr[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


# ---------------------------------------------------------------- splits and balancing

def stable_hash(*cols: str) -> Column:
    """60-bit number from the md5 of the key text (reproducible, engine-neutral)."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket100(*cols: str) -> Column:
    """0..99 bucket from the first 8 hex digits of the md5 of the key."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def split(df: DataFrame, key: str, weights=(84, 8, 8), names=("train", "validation", "test")) -> DataFrame:
    """Deterministic split by key hash (weights in percent)."""
    b = bucket100(key)
    edges, acc = [], 0
    for w in weights:
        acc += w
        edges.append(acc)
    expr = F.lit(names[-1])
    for edge, name in reversed(list(zip(edges[:-1], names[:-1]))):
        expr = F.when(b < edge, F.lit(name)).otherwise(expr)
    return df.withColumn("split", expr)


def season_split(df: DataFrame, last_season: int, season: str = "season") -> tuple[DataFrame, DataFrame]:
    """Earlier seasons train, the given season tests."""
    return df.where(F.col(season) < last_season), df.where(F.col(season) == last_season)


RANK_BITS = 16


def rank_in_class(df: DataFrame, label: str, key: str, bits: int = RANK_BITS) -> DataFrame:
    """Exact 1-based rank of each row inside its class in (hash(key), key)
    order, without a window over the whole class.

    Rows are histogrammed by (class, top ``bits`` of the hash); a window over
    that small histogram gives each bucket's offset; the final row_number
    runs per (class, bucket), so even a class holding most rows is spread over
    2**bits groups.
    """
    x = _hashed(df, key, bits)
    return _ranked(x, label, key, _histogram(x, label))


def _hashed(df: DataFrame, key: str, bits: int) -> DataFrame:
    return df.withColumn("__h", stable_hash(key)).withColumn("__b", F.shiftright(F.col("__h"), 60 - bits))


def _histogram(x: DataFrame, label: str) -> DataFrame:
    """Rows by (class, bucket), written once: at most classes x buckets rows, read several times."""
    path = scratch_dir(x.sparkSession, f"ranks-{uuid.uuid4().hex}")
    x.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n")).write.parquet(path)
    return x.sparkSession.read.parquet(path)


def _ranked(x: DataFrame, label: str, key: str, hist: DataFrame) -> DataFrame:
    offs = hist.withColumn("__off", F.sum("__n").over(
        Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
    offs = offs.select(label, "__b", F.coalesce("__off", F.lit(0)).alias("__off"))
    x = x.join(small_side(offs), [label, "__b"])
    w = Window.partitionBy(label, "__b").orderBy("__h", key)
    return x.withColumn("__rank", F.col("__off") + F.row_number().over(w)).drop("__h", "__b", "__off")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def upsample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Balance classes up to the largest: every row of a class with n rows is
    copied ``max // n`` times, and the first ``max % n`` rows in hash order get
    one more copy.  Output has ``max`` rows per class and a ``copy`` index."""
    # per-class plan (class -> n, max): one row per class, so the window over
    # it and the broadcast are bounded by the number of classes
    x = _hashed(df, key, RANK_BITS)
    hist = _histogram(x, label)
    counts = hist.groupBy(label).agg(F.sum("__n").alias("n"))
    cm = counts.withColumn("mx", F.max("n").over(Window.partitionBy(F.lit(0))))
    ranked = _ranked(x, label, key, hist).join(small_side(cm), label)
    copies = (F.col("mx") / F.col("n")).cast("bigint") + \
        F.when(F.col("__rank") <= F.col("mx") % F.col("n"), 1).otherwise(0)
    out = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    return out.drop("__rank", "n", "mx")


# ---------------------------------------------------------------- PCA

def pca_fit(df: DataFrame, cols: Sequence[str], k: int | None = None):
    """Scale and principal components of complete rows: (scale, model)."""
    rows = df.dropna(subset=list(cols))
    scale = fit_scale(rows, cols)
    z = assemble(apply_scale(rows, scale), ["z_" + c for c in cols], "__z")
    return scale, PCA(k=k or len(cols), inputCol="__z", outputCol="pcs").fit(z)


def pca_scores(df: DataFrame, fit, keep: int, prefix: str = "pc") -> DataFrame:
    """Scores ``pc1 ..`` of the first ``keep`` components, from the scale and the
    components of the training rows, one vector product a row; rows with a NULL feature get NULL scores."""
    scale, model = fit
    z = F.array(*[((F.col(c) - m) / s).cast("double") for c, (m, s) in scale.items()])
    whole = F.forall(z, lambda x: x.isNotNull())
    vector = array_to_vector(F.transform(z, lambda x: F.coalesce(x, F.lit(0.0))))
    scored = model.setInputCol("__z").setOutputCol("__pcs").transform(df.withColumn("__z", vector).withColumn("__whole", whole))
    scores = vector_to_array("__pcs")
    return scored.withColumn("__pcs", F.when(F.col("__whole"), scores)).select(*df.columns, *[F.col("__pcs")[j].alias(f"{prefix}{j + 1}") for j in range(keep)])


def pca_frame(train: DataFrame, test: DataFrame, cols: Sequence[str], share: float = 0.99) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test with the scores of the training components that together stay
    below ``share`` of the variance; also the scores' names."""
    fit = pca_fit(train, cols)
    keep = pca_keep([float(x) for x in fit[1].explainedVariance], share)
    return pca_scores(train, fit, keep), pca_scores(test, fit, keep), [f"pc{j + 1}" for j in range(keep)]


def bind_effects(train: DataFrame, test: DataFrame, scores: Sequence[str], home: str = "home_team_id", away: str = "away_team_id",
                 out: str = "features") -> tuple[DataFrame, DataFrame]:
    """One vector of the scores and the dummies of the home and the away team.  Teams
    that only the test has get no dummy; the pairings of ``fixed_effects`` are as
    many as the square of the teams, the teams themselves are not."""
    idx = StringIndexer(inputCols=[home, away], outputCols=["__h", "__a"], handleInvalid="keep").fit(train)
    hot = OneHotEncoder(inputCols=["__h", "__a"], outputCols=["__hv", "__av"], dropLast=True).fit(idx.transform(train))
    bind = VectorAssembler(inputCols=[*scores, "__hv", "__av"], outputCol=out, handleInvalid="skip")
    return tuple(bind.transform(hot.transform(idx.transform(d))).drop("__h", "__a", "__hv", "__av") for d in (train, test))


def pca_keep(explained: Sequence[float], share: float = 0.99) -> int:
    """Largest k whose cumulative share is still *below* ``share`` (the
    reference keeps one component fewer than "reaches 99 %"); at least 1."""
    acc, k = 0.0, 0
    for v in explained:
        acc += v
        if acc < share:
            k += 1
        else:
            break
    return max(k, 1)


def pca_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Component share of variance and its running sum, as a small table."""
    _, pm = pca_fit(df, cols)
    shares = [float(x) for x in pm.explainedVariance.toArray()]
    spark = df.sparkSession
    t = spark.createDataFrame([(i + 1, s) for i, s in enumerate(shares)], "component int, share double")
    return t.withColumn("cum_share", F.sum("share").over(
        Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)))


LEVELS = OUTCOME_LEVELS
