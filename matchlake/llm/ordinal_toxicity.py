"""Toxicity by cumulative-link ordinal regression.

``P(grade > k | x) = sigmoid(w x - theta_k)`` with thresholds ``theta_0 < theta_1
< ...`` and one weight vector ``w`` for all of them; the expected severity is the
sum of these probabilities over the thresholds.  Features are words and word
beginnings, with ``log(1 + count)`` as value.

The model is fitted on at most ``max_labelled`` labelled documents (those with the
smallest hash of their id): their feature counts are a grouped aggregation, the
``max_features`` features that best tell the labels apart (by likelihood ratio) form the vocabulary, and
the fit itself runs in one task over those rows' vocabulary features only, at most
``max_labelled`` times the vocabulary.  Every document is then scored.

Labels say toxic or not.  Grades above 0 are set by how many of the strongly
toxic words a toxic document has, by terciles of the labelled toxic documents:
mild, medium and severe.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, col, free_name, packed, stored, unpacked

MAX_LABELLED = 20_000
MAX_FEATURES = 5_000
MIN_DOCUMENTS = 4  # labelled documents that must show a feature
STRONG_ODDS = 3.0  # log odds from which a word counts as strongly toxic
LEVELS = 3  # grades above 0
MIN_RATIO = 12.0
RIDGE = 1e-4
STEPS = 300
PREFIXES = (4, 5)
FEATURE_CHARS = 40

_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> Counter:
    """Counts of a text's words, and of the first letters (``abcd*``) of longer ones."""
    out: Counter = Counter()
    for w, n in Counter(_WORD.findall((text or "").lower())).items():
        out[w[:FEATURE_CHARS]] += n
        for k in PREFIXES:
            if len(w) > k:
                out[w[:k] + "*"] += n
    return out


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each feature, toxic and all, summed within a batch."""
    for pdf in frames:
        every, toxic = Counter(), Counter()
        for text, t in zip(pdf["text"], pdf["toxic"], strict=True):
            found = features(text).keys()
            every.update(found)
            if t:
                toxic.update(found)
        yield pd.DataFrame({"f": list(every), "n": list(every.values()), "t": [toxic[f] for f in every]})


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, texts) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        score = np.zeros(len(texts))
        for i, text in enumerate(texts):
            for f, n in features(text).items():
                at = self.index.get(f)
                if at is not None:
                    score[i] += self.weights[at] * np.log1p(n)
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))


def fit(doc: np.ndarray, at: np.ndarray, x: np.ndarray, grades: np.ndarray, size: int, levels: int = LEVELS, ridge: float = RIDGE,
        steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps (Adam) on the likelihood of the
    grades.  Document ``doc[j]`` has value ``x[j]`` for feature ``at[j]``.  Thresholds
    are the first one plus positive gaps, so they stay ordered."""
    n = len(grades)
    share = np.clip([np.mean(grades > k) if n else 0.0 for k in range(levels)], 1e-3, 1 - 1e-3)
    theta = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(theta), 0.1))
    p = np.concatenate([np.zeros(size), theta[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    edge = np.arange(levels + 2)
    for step in range(1, steps + 1):
        w, theta = p[:size], p[size] + np.r_[0.0, np.cumsum(np.exp(p[size + 1:]))]
        score = np.bincount(doc, x * w[at], n)
        # P(grade > k) for k = -1 .. levels: certain, the thresholds, impossible
        s = np.c_[np.ones(n), 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -500, 500))), np.zeros(n)]
        prob = np.maximum(s[np.arange(n), grades] - s[np.arange(n), grades + 1], 1e-12)
        slope = s * (1 - s)
        upper, lower = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        d_score = (upper - lower) / prob / n
        d_theta = np.array([(-upper[grades == k] / prob[grades == k]).sum() + (lower[grades == k - 1] / prob[grades == k - 1]).sum() for k in edge[1:-1]]) / n
        g = np.concatenate([np.bincount(at, x * d_score[doc], size) - ridge * w, [d_theta.sum()], np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(p[size + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:size], p[size] + np.r_[0.0, np.cumsum(np.exp(p[size + 1:]))]


def _vectors(index: dict[str, int], strong: frozenset[str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text, t, h in zip(pdf["text"], pdf["toxic"], pdf["h"], strict=True):
                found = features(text)
                pairs = sorted((index[f], float(np.log1p(n))) for f, n in found.items() if f in index)
                rows.append((bool(t), h, [i for i, _ in pairs], [v for _, v in pairs], sum(n for f, n in found.items() if f in strong)))
            yield pd.DataFrame(rows, columns=["toxic", "h", "at", "value", "strong"])

    return run


def _fitted(size: int, levels: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "toxic"])  # the same order, and so the same sums, in every run
        toxic, strong = pdf["toxic"].to_numpy(bool), pdf["strong"].to_numpy(float)
        cuts = np.quantile(strong[toxic], np.arange(1, levels) / levels) if toxic.any() else np.zeros(levels - 1)
        grades = np.where(toxic, 1 + (strong[:, None] > cuts[None, :]).sum(axis=1), 0)
        doc = np.repeat(np.arange(len(pdf)), [len(a) for a in pdf["at"]])
        weights, thresholds = fit(doc, np.concatenate([*pdf["at"], []]).astype(np.int64), np.concatenate([*pdf["value"], []]), grades, size, levels)
        return pd.DataFrame({"weights": [weights.tolist()], "thresholds": [thresholds.tolist()]})

    return run


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic", *, max_labelled: int = MAX_LABELLED,
          max_features: int = MAX_FEATURES, levels: int = LEVELS) -> Model:
    """Fits the model.  Labels that are NULL or name no document count for nothing;
    a document with several labels counts as toxic if one says so."""
    bounded_batches(docs)
    chosen = labels.select(col(doc_id).alias("id"), (col(toxic).cast("int") != 0).alias("toxic")).filter("id is not null and toxic is not null")
    chosen = chosen.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    chosen = stored(chosen, "labelled")
    sample = docs.select(col(doc_id).alias("id"), col(text).alias("text")).join(F.broadcast(chosen), "id").select("text", "toxic", F.xxhash64("text").alias("h"))
    counts = sample.mapInPandas(_counted, "f string, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).filter(F.col("n") >= MIN_DOCUMENTS)
    total = sample.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("int")).alias("t")).first()
    of_toxic, of_clean = float(total["t"] or 0), float(total["n"] - (total["t"] or 0))
    odds = F.log((F.col("t") + 0.5) / (of_toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (of_clean + 1))
    # log-likelihood ratio of feature and label: above MIN_RATIO they hardly meet by chance
    cells = [(F.col("t"), F.col("n") * of_toxic), (F.col("n") - F.col("t"), F.col("n") * of_clean),
             (of_toxic - F.col("t"), (total["n"] - F.col("n")) * of_toxic), (of_clean - F.col("n") + F.col("t"), (total["n"] - F.col("n")) * of_clean)]
    ratio = 2 * sum((F.when((seen > 0) & (mean > 0), seen * F.log(seen * float(total["n"]) / mean)).otherwise(0.0) for seen, mean in cells), F.lit(0.0))
    best = counts.select("f", odds.alias("odds"), ratio.alias("ratio")).filter(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "f").limit(max_features).collect()
    index = {r["f"]: k for k, r in enumerate(best)}
    strong = frozenset(r["f"] for r in best if r["odds"] >= STRONG_ODDS and not r["f"].endswith("*"))
    vectors = sample.mapInPandas(_vectors(index, strong), "toxic boolean, h long, at array<int>, value array<double>, strong long")
    one = vectors.groupBy(F.lit("all").alias("model")).applyInPandas(_fitted(len(index), levels), "weights array<double>, thresholds array<double>").first()
    if one is None:  # no labelled document: nothing is toxic
        return Model({}, np.zeros(0), np.full(levels, 50.0))
    return Model(index, np.array(one["weights"]), np.array(one["thresholds"]))


_SCORE = T.StructType([T.StructField("p_toxic", T.DoubleType()), T.StructField("expected_severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])


def scored(text: Column, model: Model) -> Column:
    """Struct of ``p_toxic`` (grade above 0), ``expected_severity`` and ``grade``
    (the median of the grade's distribution)."""

    @F.pandas_udf(_SCORE)
    def udf(texts: pd.Series) -> pd.DataFrame:
        above = model.above(texts.tolist())
        return pd.DataFrame({"p_toxic": above[:, 0], "expected_severity": above.sum(axis=1), "grade": (above >= 0.5).sum(axis=1).astype("int32")})

    return udf(text)


def grade(docs: DataFrame, model: Model, text: str = "text", *, carry: list[str] | None = None, out: str = "toxicity") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus the struct column
    ``out`` of :func:`scored`.

    Defined results: NULL and empty texts have no features, so they get what the
    thresholds alone give.  Repeated rows get equal results.  If ``docs`` has a
    column ``out``, the new one gets a leading underscore; other names are free.
    An empty table gives an empty result.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    return docs.select(packed(docs, names).alias("row"), scored(col(text), model).alias("s")).select(*unpacked(names), F.col("s").alias(out))
