"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document becomes a vector of transformed text statistics.  For every
(language, source) the centre and covariance of the half of its documents with
the smallest covariance determinant are found by concentration steps from two
starts, until the determinants stop falling, and a document whose Mahalanobis
distance from its group's estimate is too large is rejected.  The estimates alone
set the scale: a group's small numbers are made up for by its language's estimate,
in proportion, and nothing else is added.

Statistics, distances and quantiles cover all rows: a concentration step is one
grouped aggregation over the narrow statistics table (sums, cross-products and a
histogram of distances, all combined map-side), so a source holding a third of the
rows is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, broadcast_if_small, col, free_name, packed, stored, trim, unpacked

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LOWER = np.zeros(256, bool)
_IS_LOWER[97:123] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_punct"]


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a window of five consecutive words that occurs at least
    twice in the list; every occurrence counts, the first included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.uint64)
    if len(ids) == n:
        return 0
    m = n - WINDOW + 1
    key = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        key += (w[k:k + m] + np.uint64(1)) * _MULT[k]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(same):
        return 0
    a, b = order[same], order[same + 1]
    if not all(np.array_equal(w[a + k], w[b + k]) for k in range(WINDOW)):  # a 64-bit collision: compare the windows themselves
        seen: dict[tuple, list[int]] = {}
        for p, window in enumerate(zip(*(w[k:k + m].tolist() for k in range(WINDOW)), strict=True)):
            seen.setdefault(window, []).append(p)
        hits = np.array([p for at in seen.values() if len(at) > 1 for p in at], np.int64)
    else:
        hits = np.unique(np.concatenate([a, b]))
    edge = np.zeros(n + 1, np.int64)
    edge[hits] += 1
    edge[hits + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edge[:n])))


def text_statistics(raw: bytes) -> tuple[int, ...]:
    """The values of STATS for one text in UTF-8."""
    words = raw.split()
    a = np.frombuffer(raw, np.uint8)
    count = np.bincount(a, minlength=256)
    starts = int(count.sum() - count[128:192].sum())  # code points: bytes that continue none
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return (len(words), starts - int(count[_IS_SPACE].sum()), int(count[_IS_SYMBOL].sum()), dup, repeated_words(words),
            lines, int(count[_IS_UPPER].sum()), int(count[_IS_LOWER].sum()), int(count[_IS_DIGIT].sum()), int(count[_IS_PUNCT].sum()))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in STATS]))
def statistics_of(raw: pd.Series) -> pd.DataFrame:
    trim()
    return pd.DataFrame([text_statistics(bytes(x) if x is not None else b"") for x in raw], columns=STATS)


#: Pseudo-counts of words and characters at the language's usual rates, so that short
#: texts are no outliers by chance.
PRIOR_WORDS, PRIOR_CHARS = 100.0, 600.0


def _rates(s: Column) -> list[Column]:
    """Characters a word, and the shares of capitals and of punctuation and symbols."""
    return [F.try_divide(s["word_chars"], s["n_words"]), F.try_divide(s["n_upper"], s["word_chars"]), F.try_divide(s["n_punct"], s["word_chars"])]


def _vector(s: Column, usual: Column) -> list[Column]:
    """Transformed statistics.  All vary in nearly every text, so that their spread can be
    estimated; those that are zero in most texts (repeats, digits) are left to the base rules."""
    per_char = lambda c, u: F.log1p(100.0 * (c + PRIOR_CHARS * u) / (s["word_chars"] + PRIOR_CHARS))
    return [F.log((s["word_chars"] + PRIOR_WORDS * usual[0]) / (s["n_words"] + PRIOR_WORDS)), per_char(s["n_upper"], usual[1]), per_char(s["n_punct"], usual[2])]


DIMS = 3
BINS_PER_E = 10  # histogram bins of the squared distance per factor e
MAX_STEPS = 50
FALL = 1e-3  # a log determinant that falls by less has stopped falling
PRIOR_ROWS = 50.0  # rows that a language's estimate counts for in its sources' estimates
ALPHA = 1e-9  # share of clean normal vectors beyond the cutoff
NO_SPREAD = 1e-9  # relative variance below which a direction has none
BROADCAST_GROUPS = 20_000  # rows of some 30 doubles: at most 5 MB


def chi2_quantile(q: float, df: int) -> float:
    """Wilson-Hilferty approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(q)
    return df * (1 - 2 / (9 * df) + z * (2 / (9 * df)) ** 0.5) ** 3


def _pairs(dims: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(dims) for j in range(i, dims)]


def _shape(n: float, s1: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = s1 / n
    cov = np.zeros((len(s1), len(s1)))
    for (i, j), v in zip(_pairs(len(s1)), s2, strict=True):
        cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
    return mean, cov


def whitening(cov: np.ndarray) -> np.ndarray:
    """W with |W x|^2 = x' inv(cov) x; directions without spread have no weight."""
    spread = np.sqrt(np.maximum(np.diag(cov), 0.0))
    inverse = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    values, vectors = np.linalg.eigh(cov * np.outer(inverse, inverse))
    root = np.divide(1.0, np.sqrt(np.abs(values)), out=np.zeros_like(values), where=values > NO_SPREAD)
    return (vectors * root).T * inverse


def _log_determinant(cov: np.ndarray) -> float:
    return float(np.log(np.maximum(np.linalg.eigvalsh(cov), 1e-12)).sum())


FIT = "grp string, start int, n long, mean array<double>, white array<double>, cov array<double>, logdet double, before double"


def _fit(grp: str, start: int, n: float, mean: np.ndarray, cov: np.ndarray, before: float, white: np.ndarray | None = None) -> pd.DataFrame:
    white = whitening(cov) if white is None else white
    return pd.DataFrame({"grp": [grp], "start": [int(start)], "n": [int(n)], "mean": [mean.tolist()], "white": [white.ravel().tolist()], "cov": [cov.ravel().tolist()],
                         "logdet": [_log_determinant(cov)], "before": [float(before)]})


def _lowest(bins: pd.DataFrame, rows: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the ``rows`` rows at the least distances; the bin in which
    they end counts in part."""
    n = bins["n"].to_numpy(float)
    dims = len(bins["mean"].iloc[0])
    share = np.clip((rows - (n.cumsum() - n)) / n, 0.0, 1.0)
    s = share @ np.stack(bins["sums"].to_numpy()).astype(float)
    return _shape(float(share @ n), s[:dims], s[dims:])


def _median(bins: pd.DataFrame) -> float:
    """The median squared distance, between the ends of its bin by rank."""
    n = bins["n"].to_numpy(float)
    k = int(np.searchsorted(n.cumsum(), 0.5 * n.sum() - 1e-9))
    return float(np.exp((bins["bin"].iloc[k] + (0.5 * n.sum() - n[:k].sum()) / n[k]) / BINS_PER_E))


def _concentrated(bins: pd.DataFrame) -> pd.DataFrame:
    """One concentration step of one group and start: the moments of the half of the
    rows with the least distances."""
    bins = bins.sort_values("bin")
    total, dims = float(bins["n"].sum()), len(bins["mean"].iloc[0])
    mean, cov = _lowest(bins, min(total, (total + dims + 1) // 2))
    return _fit(bins["grp"].iloc[0], bins["start"].iloc[0], total, mean, cov, bins["logdet"].iloc[0])


def _reweighted(bins: pd.DataFrame) -> pd.DataFrame:
    """The moments of all rows within the 97.5 % quantile, distances being scaled by
    their median (the usual reweighting)."""
    bins = bins.sort_values("bin")
    dims = len(bins["mean"].iloc[0])
    bound = np.log(chi2_quantile(0.975, dims) * _median(bins) / chi2_quantile(0.5, dims)) * BINS_PER_E
    n, place = bins["n"].to_numpy(float), bins["bin"].to_numpy(float)
    mean, cov = _lowest(bins, max(float(n @ np.clip(bound - place, 0.0, 1.0)), (n.sum() + dims + 1) // 2))
    return _fit(bins["grp"].iloc[0], bins["start"].iloc[0], n.sum(), mean, cov, 0.0)


def _calibrated(bins: pd.DataFrame) -> pd.DataFrame:
    """The same shape, sized by the median of the group's own distances."""
    bins = bins.sort_values("bin")
    r = bins.iloc[0]
    mean = np.array(r["mean"], float)
    cov = np.array(r["cov"], float).reshape(len(mean), -1) * (_median(bins) / chi2_quantile(0.5, len(mean)))
    return _fit(r["grp"], r["start"], bins["n"].sum(), mean, cov, 0.0)


def _starts(signs: pd.DataFrame) -> pd.DataFrame:
    """Two starts of a group: distances scaled by each statistic's own spread, and
    by the covariance of the directions from the median (spatial signs)."""
    r = signs.iloc[0]
    med, mad = np.array(r["med"], float), np.array(r["mad"], float) * 1.4826
    dims = len(med)
    scale = np.diag(np.divide(1.0, mad, out=np.zeros_like(mad), where=mad > 0))
    _, cov = _shape(1.0, np.zeros(dims), np.array([r[f"m{k}"] for k in range(len(_pairs(dims)))], float))
    cov = cov / max(np.trace(cov), 1e-9) * dims + 0.05 * np.eye(dims)
    return pd.concat([_fit(r["grp"], k, 0, med, np.zeros((dims, dims)), 0.0, w) for k, w in enumerate((scale, whitening(cov) @ scale))]).assign(logdet=np.inf)


def _distance(xs: list[Column], mean: Column, white: Column) -> Column:
    """Squared Mahalanobis distance."""
    total = F.lit(0.0)
    for i in range(len(xs)):
        y = sum((white[i * len(xs) + j] * (x - mean[j]) for j, x in enumerate(xs)), F.lit(0.0))
        total = total + y * y
    return total


def _medians(rows: DataFrame, values: list[Column], name: str, by: str = "grp") -> DataFrame:
    return rows.groupBy(by).agg(F.array(*[F.percentile_approx(v, 0.5, 1000) for v in values]).alias(name))


def _binned(rows: DataFrame, fits: DataFrame, xs: list[Column], moments: bool = True) -> DataFrame:
    """Rows of each group and start by the bin of their distance: counts, and the
    sums and products of the statistics."""
    near = rows.join(broadcast_if_small(fits, BROADCAST_GROUPS), "grp")
    place = F.floor(F.log(F.greatest(_distance(xs, F.col("mean"), F.col("white")), F.lit(1e-6))) * BINS_PER_E).cast("int")
    products = [F.col(f"x{i}") * F.col(f"x{j}") for i, j in _pairs(len(xs))]
    sums = [F.array(*[F.sum(v) for v in xs + products]).alias("sums")] if moments else []
    bins = near.select("grp", "start", *xs, place.alias("bin")).groupBy("grp", "start", "bin").agg(F.count("*").alias("n"), *sums)
    return bins.join(fits.select("grp", "start", "mean", "cov", "logdet"), ["grp", "start"])


def estimates(rows: DataFrame) -> DataFrame:
    """``grp, n, mean, cov, white`` of each ``grp`` of ``rows(grp, x0, x1, ..)``: the reweighted
    minimum covariance determinant of its rows."""
    xs = [F.col(f"x{k}") for k in range(len(rows.columns) - 1)]
    med = stored(_medians(rows, xs, "med"), "med")
    near = rows.join(broadcast_if_small(med, BROADCAST_GROUPS), "grp")
    mad = _medians(near, [F.abs(x - F.col("med")[k]) for k, x in enumerate(xs)], "mad")
    spread = stored(med.join(mad, "grp"), "spread")
    near = rows.join(broadcast_if_small(spread, BROADCAST_GROUPS), "grp")
    z = [F.coalesce(F.try_divide(x - F.col("med")[k], F.col("mad")[k] * 1.4826), F.lit(0.0)) for k, x in enumerate(xs)]
    near = near.select("grp", *[v.alias(f"z{k}") for k, v in enumerate(z)])
    near = near.withColumn("norm", F.greatest(sum((F.col(f"z{k}") * F.col(f"z{k}") for k in range(len(xs))), F.lit(0.0)), F.lit(1e-9)))
    signs = near.groupBy("grp").agg(*[F.avg(F.col(f"z{i}") * F.col(f"z{j}") / F.col("norm")).alias(f"m{k}") for k, (i, j) in enumerate(_pairs(len(xs)))])
    fits = stored(signs.join(spread, "grp").groupBy("grp").applyInPandas(_starts, FIT), "start")
    settled = []
    for step in range(MAX_STEPS):  # only what still falls takes another step
        new = stored(_binned(rows, fits, xs).groupBy("grp", "start").applyInPandas(_concentrated, FIT), f"step{step}")
        falls = F.col("before") - F.col("logdet") > FALL
        settled.append(new if step == MAX_STEPS - 1 else new.filter(~falls))
        fits = new.filter(falls)
        if fits.isEmpty():
            break
    ends = reduce(DataFrame.unionByName, settled)
    best = ends.groupBy("grp").agg(F.min_by(F.struct(*[c for c in ends.columns if c != "grp"]), F.struct("logdet", "start")).alias("e")).select("grp", "e.*")
    best = stored(best, "least")
    whole = stored(_binned(rows, best, xs).groupBy("grp", "start").applyInPandas(_reweighted, FIT), "reweighted")
    return stored(_binned(rows, whole, xs, moments=False).groupBy("grp", "start").applyInPandas(_calibrated, FIT), "fits").select("grp", "n", "mean", "cov", "white")


def blended(n: float, mean: np.ndarray, cov: np.ndarray, wide_mean: np.ndarray, wide_cov: np.ndarray, prior_rows: float) -> tuple[np.ndarray, np.ndarray]:
    """The estimate of ``n`` rows together with a wider one that counts for ``prior_rows``.
    A statistic without spread in the group has at least the wider variance."""
    w, gap = n / (n + prior_rows), mean - wide_mean
    out = w * cov + (1 - w) * wide_cov + w * (1 - w) * np.outer(gap, gap)
    flat = np.diag(cov) <= NO_SPREAD * np.diag(wide_cov)
    out[flat, flat] = np.maximum(np.diag(out), np.diag(wide_cov))[flat]
    return wide_mean + w * gap, out


def _blender(whole: tuple[np.ndarray, np.ndarray], prior_rows: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                fits = [(e["n"], np.array(e["mean"], float), np.array(e["cov"], float).reshape(DIMS, DIMS)) for e in (r.wide_e, r.own_e)]
                mean, cov = whole
                for n, m, c in fits:
                    mean, cov = blended(n, m, c, mean, cov, prior_rows)
                out.append((r.own, mean.tolist(), whitening(cov).ravel().tolist(), list(r.usual)))
            yield pd.DataFrame(out, columns=["own", "mean", "white", "usual"])

    return run


def assess(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", *, alpha: float = ALPHA,
           prior_rows: float = PRIOR_ROWS, carry: list[str] | None = None, out: str = "quality") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: the statistics, ``base_failed``, ``distance`` (squared, NULL if the
    row took no part) and ``kept``.

    Every (language, source) has an estimate of its own; it is blended with its language's,
    and that with the corpus's, which each count for ``prior_rows`` rows.

    Defined results: a NULL or empty text has no words and so fails the base
    rules; very long texts are read whole, one batch at a time; NULL languages and sources
    are groups of their own; a distance equal to the cutoff is kept; a statistic without any
    spread in the corpus has no weight.  Repeated rows each count and get the same verdict.  If
    there is a column ``out`` already, the new one gets a leading underscore; all other
    names are free.  An empty table gives an empty result.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    name = lambda c: F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit("-"))
    raw = docs.select(packed(docs, names).alias("row"), statistics_of(col(text).cast("binary")).alias("s"), name(lang).alias("wide"), F.concat(name(lang), F.lit(" "), name(source)).alias("own"))
    # Narrow rows are stored with their statistics; whole texts are read again
    # instead, as the verdict needs nothing but a row's own statistics and its fit.
    narrow = stored(raw if carry is not None else raw.drop("row"), "statistics")
    table = narrow if carry is not None else raw
    s = F.col("s")
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
    passing = narrow.filter(~failed).select("own", "wide", "s")
    usual = stored(_medians(passing, _rates(s), "usual", "wide"), "usual")
    part = passing.join(broadcast_if_small(usual, BROADCAST_GROUPS), "wide")
    part = stored(part.select("own", "wide", *[v.alias(f"x{k}") for k, v in enumerate(_vector(s, F.col("usual")))]), "vectors")
    levels = F.explode(F.array(F.concat(F.lit("1"), "own"), F.concat(F.lit("2"), "wide"), F.lit("3")))
    found = estimates(part.select(levels.alias("grp"), *[f"x{k}" for k in range(DIMS)]))
    groups = part.groupBy("own", "wide").agg(F.count("*").alias("rows")).join(usual, "wide")
    groups = groups.select("own", "usual", F.concat(F.lit("1"), "own").alias("own_g"), F.concat(F.lit("2"), "wide").alias("wide_g"))
    for level in ("own", "wide"):
        groups = groups.join(broadcast_if_small(found.select(F.col("grp").alias(f"{level}_g"), F.struct("n", "mean", "cov").alias(f"{level}_e")), BROADCAST_GROUPS), f"{level}_g")
    whole = found.filter("grp = '3'").first()  # one row; none if no text passes, and then there are no groups
    whole = (np.array(whole["mean"]), np.array(whole["cov"]).reshape(DIMS, DIMS)) if whole else (np.zeros(DIMS), np.eye(DIMS))
    fits = groups.select("own", "usual", "own_e", "wide_e").mapInPandas(_blender(whole, prior_rows), "own string, mean array<double>, white array<double>, usual array<double>")
    fits = stored(fits, "blended")
    joined = table.select("row", "s", "own", failed.alias("failed")).join(broadcast_if_small(fits, BROADCAST_GROUPS), "own", "left")
    d2 = F.when(~F.col("failed"), _distance(_vector(s, F.col("usual")), F.col("mean"), F.col("white")))
    joined = joined.select("row", "s", "failed", d2.alias("d2"))
    verdict = ~F.col("failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= chi2_quantile(1 - alpha, DIMS))
    return joined.select(*unpacked(names), F.struct(*[s[c].alias(c) for c in STATS], F.col("failed").alias("base_failed"), F.col("d2").alias("distance"), verdict.alias("kept")).alias(out))
