"""Exact top-k search by inner product with a KD-tree for each shard.

Vectors are dealt to shards of about SHARD_ROWS by a hash of their row's number, so
that an id which many rows repeat is spread.  A shard's
tree splits at the median of the widest component and keeps a tight bounding box
for each node.  The highest score that a box can give a query is the sum of the
larger of ``q * low`` and ``q * high`` over the components; nodes are visited
best first, and a search ends where no box can beat the query's k-th score.

A query is searched in its own shard first; its k-th score from there goes along
to all other shards, which so prune from the start and return only what beats it.
Rows reach a task sorted by shard, candidates first: it holds one shard's vectors
and one batch of queries at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import col, stored

K = 10
SHARD_ROWS = 16384
LEAF_ROWS = 256
EXACT_FLOAT = 1 << 53
_LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(vector: Column, factor: float = 1024.0) -> Column:
    """floor(factor * x) of each component; NULL if the vector or a component is
    NULL or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _largest(v: np.ndarray) -> int:
    return max(int(v.max()), -int(v.min())) if v.size else 0


class Tree:
    """A KD-tree over integer vectors; rows must come in the order of their ids and
    then their numbers, which tell rows of one id apart."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.low, self.high, self.least, self.children, self.rows = [], [], [], [], []
        self.ids, self.numbers, self.vectors = ids, numbers, vectors
        self.top = _largest(vectors)
        todo = [(np.arange(len(ids)), None)]
        while todo:
            rows, parent = todo.pop()
            at = len(self.low)
            v = vectors[rows]
            self.low.append(v.min(axis=0))
            self.high.append(v.max(axis=0))
            self.least.append(int(ids[rows].min()))
            self.children.append([])
            self.rows.append(None)
            if parent is not None:
                self.children[parent].append(at)
            if len(rows) <= leaf_rows:
                self.rows[at] = rows
                continue
            spread = self.high[at].astype(float) - self.low[at]
            half = len(rows) // 2
            if spread.max(initial=0) > 0:
                rows = rows[np.argsort(v[:, int(np.argmax(spread))], kind="stable")]
            todo += [(np.sort(rows[:half]), at), (np.sort(rows[half:]), at)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.floats = vectors.astype(float)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest score of each query in each node's box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        if self.exact(queries):
            return (up.astype(float) @ self.high.T.astype(float) + down.astype(float) @ self.low.T.astype(float))
        return np.clip(up.astype(object) @ self.high.T.astype(object) + down.astype(object) @ self.low.T.astype(object), *_LONG)

    def exact(self, queries: np.ndarray) -> bool:
        """Whether scores are exact in floating point."""
        width = max(1, self.vectors.shape[1])
        return _largest(queries) * self.top * width < EXACT_FLOAT

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, k: int, worst: tuple[int, int, int] | None) -> list[tuple[int, int, int]]:
        """The (score, id, number) of at most ``k`` rows other than number ``own`` that
        beat ``worst``, the query's k-th so far; best first."""
        best: list[tuple[int, int, int]] = []  # a heap of (score, -id, -number)
        limit = (worst[0], -worst[1], -worst[2]) if worst else None
        heap = [(-bounds[0], 0)] if len(self.ids) else []
        exact = self.exact(query)
        while heap:
            bound, node = heapq.heappop(heap)
            if limit is not None and (-bound < limit[0] or (-bound == limit[0] and -self.least[node] < limit[1])):
                if -bound < limit[0]:
                    break
                continue
            rows = self.rows[node]
            if rows is None:
                for child in self.children[node]:
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            scores = self.floats[rows] @ query.astype(float) if exact else np.clip(self.vectors[rows].astype(object) @ query.astype(object), *_LONG)
            near = np.flatnonzero(scores >= limit[0]) if limit is not None else np.arange(len(rows))
            if len(near) > k:  # ties keep their order, that of the ids
                near = near[np.argsort(-scores[near], kind="stable")[:k + 1]]
            for i in near.tolist():
                item = (int(scores[i]), -int(self.ids[rows[i]]), -int(self.numbers[rows[i]]))
                if -item[2] == own or (limit is not None and item <= limit):
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                else:
                    heapq.heappushpop(best, item)
                if len(best) == k and (limit is None or best[0] > limit):
                    limit = best[0]
        return [(s, -i, -n) for s, i, n in sorted(best, reverse=True)]


_OUT = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("number", pa.int64()), ("score", pa.int64())])


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def _searcher(k: int, leaf_rows: int):
    """Searches partitions sorted by (width, shard, kind, id, number): a shard's vectors
    (kind 0) and then the queries sent to it (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, ids, numbers, vectors = None, None, [], [], []
        for batch in batches:
            width, shard, kind = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("width", "shard", "kind"))
            cuts = np.flatnonzero(np.r_[True, (width[1:] != width[:-1]) | (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(cuts, np.r_[cuts[1:], batch.num_rows], strict=True):
                if at != (width[a], shard[a]):
                    at, tree, ids, numbers, vectors = (width[a], shard[a]), None, [], [], []
                part = batch.slice(a, b - a)
                own, number = part.column("id").to_numpy(), part.column("number").to_numpy()
                v = _vectors(part.column("v"), int(width[a])) if width[a] else np.zeros((b - a, 0), np.int64)
                if kind[a] == 0:
                    ids.append(own)
                    numbers.append(number)
                    vectors.append(v)
                    continue
                if not ids:
                    continue
                tree = tree or Tree(np.concatenate(ids), np.concatenate(numbers), np.concatenate(vectors), leaf_rows)
                bounds = tree.bounds(v)
                kth = list(zip(*(part.column(c).to_pylist() for c in ("kth", "kth_id", "kth_number")), strict=True))
                out = [(int(own[n]), int(q), i, m, s) for n, q in enumerate(number)
                       for s, i, m in tree.search(v[n], bounds[n], int(q), k, None if kth[n][0] is None else kth[n])]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (zip(*out, strict=True) if out else [()] * len(_OUT))], schema=_OUT)

    return run


_KTH = ["kth", "kth_id", "kth_number"]


def _search(candidates: DataFrame, queries: DataFrame, k: int, leaf_rows: int) -> DataFrame:
    rows = candidates.select("width", "shard", F.lit(0).alias("kind"), "id", "number", "v", *[F.lit(None).cast("long").alias(c) for c in _KTH])
    rows = rows.unionByName(queries.select("width", "shard", F.lit(1).alias("kind"), "id", "number", "v", *_KTH))
    rows = rows.repartition("width", "shard").sortWithinPartitions("width", "shard", "kind", "id", "number")
    return rows.mapInArrow(_searcher(k, leaf_rows), "query_id long, query long, vec_id long, number long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "number")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "v", *, k: int = K, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The ``k`` highest inner products of each query with every row but its own:
    ``query_id, rank, vec_id, score``; ties to the smaller id.

    ``vectors`` has integer vectors (``vector``, array<bigint>); ``is_query`` says
    which of its ids are queries.  Defined results: NULL vectors and NULL ids take
    no part; rows that repeat an id are rows of their own, as candidates and as queries
    (each with its ``k`` results under the one id); vectors are compared with those of
    equal length only; scores beyond a long are its bounds.  Extra columns are ignored.
    An empty table gives an empty result.
    """
    rows = vectors.select(col(vec_id).cast("long").alias("id"), col(vector).cast("array<bigint>").alias("v"), is_query.alias("q"))
    rows = rows.filter("id is not null and v is not null").withColumn("number", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("width", F.size("v")), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))
    queries = rows.filter("q")
    home = stored(_search(rows, queries.withColumns({c: F.lit(None).cast("long") for c in _KTH}), k, leaf_rows), "home")
    if shards == 1:
        return _ranked(home, k).select("query_id", "rank", "vec_id", "score")
    kth = _ranked(home, k).filter(F.col("rank") == k).select("query", F.col("score").alias("kth"), F.col("vec_id").alias("kth_id"), F.col("number").alias("kth_number"))
    others = queries.join(kth, F.col("number") == F.col("query"), "left").drop("query").withColumn("home", F.col("shard"))
    others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home")
    away = _search(rows, others, k, leaf_rows)
    return _ranked(home.unionByName(away), k).select("query_id", "rank", "vec_id", "score")
