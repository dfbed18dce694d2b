"""Sums of numpy blocks over all rows, as one grouped aggregate.

A task adds up its batches and emits the rows of its matrix; rows of equal place are
added by Spark's vector summarizer.  What reaches the driver is one matrix, whose size
depends on the model and not on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PLACED = "place int, v array<double>"


def summed(rows: DataFrame, block: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``block(batch)``, a matrix of ``shape``, over the batches of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                total += block(batch)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "v"])

    return added(rows.mapInArrow(run, PLACED), shape)


def added(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of the tasks' matrices, of which ``parts(place, v)`` has a row for each row."""
    sums = parts.groupBy("place").agg(Summarizer.metrics("sum").summary(array_to_vector("v")).alias("s"))
    out = np.zeros(shape)
    for r in sums.select("place", vector_to_array("s.sum").alias("v")).collect():
        out[r["place"]] = r["v"]
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of equal width as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), width)


def gramian(df: DataFrame, cols: list[str]) -> tuple[np.ndarray, ...]:
    """Of values centred by their column's mean, over the rows where both columns of a pair are
    known (neither NULL nor NaN): counts ``n``, sums ``s``, squares ``q`` and products ``g``, each p x p.
    ``s[i, j]`` and ``q[i, j]`` are those of column i over the rows that also have column j.  One
    aggregate gives the means and one the four matrices, whatever p.
    """
    p = len(cols)
    values = [F.col(f"`{c}`").cast("double") for c in cols]
    finite = [F.when(~F.isnan(v), v) for v in values]
    # NaN stands for NULL inside the array
    rows = df.select(F.array(*[F.coalesce(v, F.lit(float("nan"))) for v in finite]).alias("x"))

    def totals(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"), p)
        known = ~np.isnan(x)
        return np.stack([known.sum(axis=0), np.where(known, x, 0.0).sum(axis=0)])

    n, s = summed(rows, totals, (2, p))
    means = s / np.maximum(n, 1)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"), p) - means
        known = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        return np.concatenate([known.T @ known, x.T @ known, (x * x).T @ known, x.T @ x])

    return tuple(np.split(summed(rows, products, (4 * p, p)), 4))


def correlations(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson correlations over the rows where both columns are known; NaN where a
    column is constant there or there are fewer than two rows."""
    n, s, q, g = gramian(df, cols)
    n = np.where(n > 0, n, np.nan)
    cov = g - s * s.T / n
    var = q - s * s / n
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = cov / np.sqrt(var * var.T)
    corr[(n < 2) | (var <= 0) | (var.T <= 0)] = np.nan
    return np.clip(corr, -1, 1)


def dot(vector: Column, weights: np.ndarray) -> Column:
    """Inner product of an array column with fixed weights."""
    return F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
