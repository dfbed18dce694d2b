"""Vector codes by slice-and-intersect bitmasks.

A vector is cut into equal consecutive parts, and each part is coded by the nearest
entry (squared Euclidean distance) of its position's codebook.  For each component
the entries are sorted by their coordinate, and prefix ``j`` of that order carries
a mask of the entries in it; the entries whose coordinate lies in a range are the
XOR of two prefix masks, found by two binary searches.

A part is compared with one entry first, one of the two beside it in the component
in which the entries differ most.  Their distance is the initial radius: the nearest entry
lies in the cube of that radius around the part.  The ranges of all components
are ANDed, 64 entries a word, and the entries left, the nearest among them for
certain, are compared exactly.

Codebooks are fitted by rounds of assignment and averaging.  A task sums its parts
by entry, so a round sends to the driver at most one row for each component of each
entry; sums are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, col, free_name, packed, unpacked

PARTS, ENTRIES, ROUNDS = 8, 16, 6
_EXACT = 1 << 50  # squared distances and radii below it are exact in floating point
_MOST = (1 << 63) - 1


def scaled(vector: Column, factor: float = 4096.0) -> Column:
    """floor(factor * x) of each component, as longs (beyond a long: its bounds);
    NULL if the vector or a component is NULL or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


class Slices:
    """The codebook of one part position: ``(entries, width)`` integers."""

    def __init__(self, book: np.ndarray):
        self.book, (k, self.width) = book, book.shape
        self.words = max(1, -(-k // 64))
        bits = np.zeros((k, self.words), np.uint64)
        bits[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
        self.order = np.argsort(book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, self.order, axis=0)
        self.prefix = np.zeros((self.width, k + 1, self.words), np.uint64)
        for d in range(self.width):
            np.bitwise_or.accumulate(bits[self.order[:, d]], axis=0, out=self.prefix[d, 1:])
        spread = self.sorted[-1].astype(float) - self.sorted[0] if k else np.zeros(self.width)
        self.widest = int(np.argmax(spread)) if self.width else 0
        self.largest = max((abs(int(x)) for x in (book.max(initial=0), book.min(initial=0))), default=0)

    def _distance(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        d = x - self.book[entries]
        return (d * d).sum(axis=1)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks ``(rows, words)`` of the entries within ``radius`` in every component."""
        k = len(self.book)
        mask = np.broadcast_to(self.prefix[0, k] if self.width else np.full(self.words, ~np.uint64(0)), (len(x), self.words)).copy()
        for d in range(self.width):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            mask &= self.prefix[d][high] ^ self.prefix[d][low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, ties to the lower index, and its distance."""
        if not len(x) or not self.width:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        largest = max(self.largest, abs(int(x.max())), abs(int(x.min())))
        if 4 * largest * largest * self.width >= _EXACT and x.dtype != object:
            return Slices(self.book.astype(object)).nearest(x.astype(object))
        k, w = len(self.book), self.widest
        right = np.minimum(np.searchsorted(self.sorted[:, w], x[:, w]), k - 1).astype(np.int64)
        left = np.maximum(right - 1, 0)
        beside = np.where(x[:, w] - self.sorted[left, w] <= self.sorted[right, w] - x[:, w], left, right)
        first = self._distance(x, self.order[beside, w])
        if x.dtype == object:
            radius = np.array([math.isqrt(int(d)) + 1 for d in first], object)
        else:
            radius = np.ceil(np.sqrt(first.astype(float))).astype(np.int64)
        mask = self.candidates(x, radius)
        hit = (mask[:, np.arange(k) // 64] >> (np.arange(k) % 64).astype(np.uint64)) & np.uint64(1)
        rows, entries = np.nonzero(hit)
        d = self._distance(x[rows], entries)
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        best = np.minimum.reduceat(d, starts)
        least = np.flatnonzero(d == best[rows])
        least = least[np.r_[True, rows[least][1:] != rows[least][:-1]]]
        return entries[least], best


@dataclass
class Codebooks:
    """``entries[part][index]`` is a tuple of integers; ``width`` components a vector."""
    width: int
    entries: list[list[tuple[int, ...]]]

    def slices(self) -> list[Slices]:
        n = self.width // max(1, len(self.entries))
        fits = all(abs(x) <= _MOST >> 1 for book in self.entries for e in book for x in e)
        return [Slices(np.array(book, np.int64 if fits else object).reshape(len(book), n)) for book in self.entries]

    def flat(self) -> list[int]:
        return [x for book in self.entries for e in book for x in e]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)
    if values.size and max(abs(int(values.max())), abs(int(values.min()))) > _MOST >> 1:
        return values.astype(object)
    return values


_SUMS = "part int, entry int, place int, total string, n long"


def _sums(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = books.slices()
        n = books.width // len(slices)
        totals = [np.zeros((len(s.book), n), object) for s in slices]
        counts = [np.zeros(len(s.book), np.int64) for s in slices]
        for batch in batches:
            v = _matrix(batch.column("v"), books.width)
            exact = v.dtype == object or (v.size and max(abs(int(v.max())), abs(int(v.min()))) * len(v) >= _EXACT)
            for p, s in enumerate(slices):
                x = v[:, p * n:(p + 1) * n]
                code, _ = s.nearest(x)
                counts[p] += np.bincount(code, minlength=len(s.book))
                for e in np.unique(code):
                    part = x[code == e]
                    totals[p][e] += (part.astype(object) if exact else part).sum(axis=0).astype(object)
        rows = [(p, e, d, str(int(totals[p][e, d])), int(counts[p][e])) for p, s in enumerate(slices) for e in np.flatnonzero(counts[p]).tolist() for d in range(n)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else ((),) * 5, (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)],
                                         names=["part", "entry", "place", "total", "n"])

    return run


def usable(vectors: DataFrame, vector: str, width: int, parts: int) -> DataFrame:
    """The vectors of ``width`` components, as column ``v``."""
    v = col(vector).cast("array<bigint>")
    complete = v.isNotNull() & F.forall(v, lambda x: x.isNotNull())
    return vectors.filter(complete & (F.size(v) == width)).select(v.alias("v")) if width % parts == 0 else vectors.limit(0).select(v.alias("v"))


def train(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "v", *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the integer vectors (array<bigint>) in ``vector``.

    They start as the parts of the ``entries`` vectors with the smallest ids (NULL ids last;
    rows that repeat an id by their vectors), so a smaller table has fewer entries.
    The first of these sets the width; vectors of another one, NULL vectors and vectors
    with a NULL component take no part, and nothing does if the width is no multiple of
    ``parts``.  Entries without a part stay as they are; new ones are floor(sum / count).
    """
    bounded_batches(vectors)
    v = col(vector).cast("array<bigint>")
    whole = vectors.filter(v.isNotNull() & F.forall(v, lambda x: x.isNotNull())).select(col(vec_id).alias("id"), v.alias("v"))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    head = whole.orderBy(*order).limit(1).collect()
    if not head or len(head[0]["v"]) % parts:
        return Codebooks(len(head[0]["v"]) if head else 0, [[] for _ in range(parts)])
    width = len(head[0]["v"])
    first = whole.filter(F.size("v") == width).orderBy(*order).limit(entries).collect()
    n = width // parts
    books = Codebooks(width, [[tuple(r["v"][p * n:(p + 1) * n]) for r in first] for p in range(parts)])
    rows = usable(vectors, vector, width, parts)
    for _ in range(rounds if width else 0):
        sums = rows.mapInArrow(_sums(books), _SUMS).groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        new = [[list(e) for e in book] for book in books.entries]
        for r in sums.collect():  # at most one row for each component of each entry
            new[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(width, [[tuple(e) for e in book] for book in new])
    return books


_CODE = T.StructType([T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])


def coded(vector: Column, books: Codebooks) -> Column:
    """Struct of ``code`` (an index for each part) and ``error`` (squared distances
    summed over the parts; beyond a long: its bound) of an integer vector."""

    @F.arrow_udf(_CODE)
    def udf(vectors: pa.Array) -> pa.Array:
        slices = books.slices()
        n, fits = books.width // len(slices), np.array(vectors.value_lengths().fill_null(-1)) == books.width
        v = _matrix(vectors.filter(pa.array(fits)), books.width) if books.width else np.zeros((int(fits.sum()), 0), np.int64)
        codes, error = np.zeros((len(v), len(slices)), np.int32), np.zeros(len(v), object)
        for p, s in enumerate(slices):
            codes[:, p], distance = s.nearest(v[:, p * n:(p + 1) * n])
            error += distance.astype(object)
        at = np.flatnonzero(fits)
        out = [None] * len(vectors)
        for i, c, e in zip(at.tolist(), codes.tolist(), error.tolist(), strict=True):
            out[i] = {"code": c, "error": min(int(e), _MOST)}
        return pa.array(out, pa.struct([("code", pa.list_(pa.int32())), ("error", pa.int64())]))

    if not any(books.entries):
        return F.lit(None).cast(_CODE)
    return udf(vector)


def encode(vectors: DataFrame, books: Codebooks, vector: str = "v", *, carry: list[str] | None = None, out: str = "codes") -> DataFrame:
    """The columns of ``vectors`` (or those in ``carry``) plus the struct column
    ``out`` of :func:`coded`.

    Defined results: ``out`` is NULL for a NULL vector, for one with a NULL component and for
    one of another width than the codebooks'.  Vectors without components have code
    0 in every part and no error.  Ties go to the lower index; repeated rows get equal codes.  Long
    vectors are whole in one row.  If ``vectors`` has a column ``out``, the new one gets a
    leading underscore; other names are free.  An empty table gives an empty result.
    """
    bounded_batches(vectors)
    names = vectors.columns if carry is None else carry
    out = free_name(names, out)
    v = col(vector).cast("array<bigint>")
    v = F.when(v.isNotNull() & F.forall(v, lambda x: x.isNotNull()), v)
    return vectors.select(packed(vectors, names).alias("row"), v.alias("v")).select("row", coded(F.col("v"), books).alias("c")).select(*unpacked(names), F.col("c").alias(out))


def decoded(code: Column, books: Codebooks) -> Column:
    """The vector that a code stands for: its entries, joined."""
    tables = [F.array(*[F.array(*[F.lit(x).cast("bigint") for x in e]) for e in book]) for book in books.entries]
    return F.concat(*[F.get(t, F.get(code, F.lit(p))) for p, t in enumerate(tables)])
