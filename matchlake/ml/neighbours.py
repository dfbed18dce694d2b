"""Exact nearest neighbours without all pairs in one place.

Training vectors are put into a tree of pivots, level by level: a cell of more than
CELL_ROWS vectors gets FAN of its distinct vectors as pivots, and its vectors go to the
nearest of them.  A leaf has a pivot and a radius of its own, and so has every cell above it.  Only a
cell of equal vectors stays large, and is cut into parts by a hash of the id.

A test vector goes down the tree to its nearest leaf and is searched in one part of it
first.  Its k-th distance there bounds the search: by the triangle inequality a cell
further than that bound plus its radius holds nothing nearer, and neither does a cell beyond
the half-way plane between its pivot and a sibling's that is further than the bound.  So the vector goes down the
tree once more, only into cells that can hold something, and is sent to the leaves it reaches.

The tree is a table with a row for each cell.  Rows reach a task sorted by cell and part,
with the cell's pivots or training vectors first, so a task holds one cell's pivots, or one part of a leaf,
and one Arrow batch of vectors at a time; cells that many vectors go through are
dealt to several tasks.  Of each part a test vector gets its best ``k`` by (distance, id),
with all ties cut by id and none by batch borders.  No vector is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.joins import small_side
from matchlake.session import scratch_dir

FAN = 64
CELL_ROWS = 4096
TASK_ROWS = 65536  # vectors of one cell that one task takes down the tree
SEARCH_ROWS = 1024  # test vectors that one task compares with a part
BATCH = 256  # test vectors whose distances to a part are held at once: 8 MB
DIGITS = 9  # distances are compared after rounding, as ties should not depend on summation
SLACK = 1e-8


def _stored(df: DataFrame, name: str) -> DataFrame:
    import uuid

    path = scratch_dir(df.sparkSession, f"neighbours-{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact differences in blocks: the expansion of squares loses ties."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def _beyond(d: np.ndarray, gaps: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """What the vectors of each cell are at least away, from the distances ``d`` to the siblings' pivots and
    ``gaps`` between those: the vectors of a cell are on its pivot's side of the plane half-way to any other pivot.
    Rounding is left room for."""
    least = d - radii[None, :]
    with np.errstate(all="ignore"):
        square = d * d
        high, low = square * (1 + 1e-12), square * (1 - 1e-12)
        for i, gap in enumerate(gaps):
            plane = np.where(gap > 0, (low - high[:, i:i + 1]) / (2 * gap), 0.0)
            np.copyto(least, plane, where=np.isfinite(plane) & (plane > least))
    return least


def _tasks(df: DataFrame) -> int:
    """Partitions for rows that cost far more time than their bytes tell: adaptive execution would merge them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_STEP = "key long, cell string, d double"


def _stepper(all_in_reach: bool):
    """Streams rows sorted by (cell, part, kind): a cell's pivots (kind 0: their cells and radii) and
    the vectors in it (kind 1).  Gives the nearest pivot's cell of each vector, or with
    ``all_in_reach`` every cell that the vector's bound reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, pivots, names, radii, gaps = None, [], None, None, None, None
        for batch in batches:
            cell, part, kind = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "part", "kind"))
            cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(cuts, np.r_[cuts[1:], batch.num_rows], strict=True):
                if at != (cell[a], part[a]):
                    at, held, pivots = (cell[a], part[a]), [], None
                rows = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(rows)
                    continue
                if pivots is None:
                    pivots = np.concatenate([_matrix(h.column("vec")) for h in held])
                    names = np.concatenate([h.column("child").to_numpy(zero_copy_only=False) for h in held])
                    radii = np.concatenate([h.column("radius").to_numpy(zero_copy_only=False) for h in held])
                    gaps = _distances(pivots, pivots) if all_in_reach else None
                d = _distances(_matrix(rows.column("vec")), pivots)
                if all_in_reach:
                    bound = rows.column("bound").to_numpy(zero_copy_only=False)
                    i, j = np.nonzero(_beyond(d, gaps, radii) <= bound[:, None] + SLACK)
                else:
                    i, j = np.arange(len(d)), d.argmin(axis=1)
                key = rows.column("key").to_numpy()[i]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(names[j], pa.string()), pa.array(d[i, j], pa.float64())], names=["key", "cell", "d"])

    return run


def _down(rows: DataFrame, cells: DataFrame, reach: bool = False) -> DataFrame:
    """``(key, cell, d)``: one level down for rows ``(key, cell, vec, bound)`` in cells that have children."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / TASK_ROWS).cast("int").alias("parts"))
    children = cells.select(F.col("parent").alias("cell"), F.col("cell").alias("child"), "vec", "radius")
    own = children.join(parts, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "child", "vec", "radius",
                                              F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("bound"))
    moving = rows.join(small_side(parts), "cell").select("cell", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("child"), "vec",
                                                        F.lit(None).cast("double").alias("radius"), "key", "bound")
    return own.unionByName(moving).repartition(_tasks(rows), "cell", "part").sortWithinPartitions("cell", "part", "kind").mapInArrow(_stepper(reach), _STEP)


def _tree(train: DataFrame, cell_rows: int, fan: int) -> tuple[DataFrame, DataFrame, int]:
    """Training rows ``(id, label, vec, folds, key, cell, part)`` in their leaves; the cells
    ``(parent, cell, vec, radius, leaf, parts)``, one row each but the root; and the number of levels."""
    rows = _stored(train.withColumns({"key": F.monotonically_increasing_id(), "cell": F.lit(""), "d": F.lit(None).cast("double")}), "rows")
    done, cells, level = None, None, 0
    while True:
        sizes = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("radius"))
        sizes = _stored(sizes.withColumn("split", (F.col("n") > cell_rows) & (F.col("radius").isNull() | (F.col("radius") > 0))), f"sizes{level}")
        leaf = rows.join(small_side(sizes.where("NOT split").select("cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("parts"))), "cell")
        leaf = leaf.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        done = leaf if done is None else done.unionByName(leaf)
        if level:
            found = pivots.join(sizes, "cell").select("parent", "cell", "vec", "radius", (~F.col("split")).alias("leaf"), F.ceil(F.col("n") / cell_rows).cast("int").alias("parts"), F.lit(level).alias("level"))
            cells = found if cells is None else cells.unionByName(found)
        if not sizes.where("split").limit(1).count():
            return done, (_stored(cells, "cells") if cells is not None else None), level
        inside = rows.join(small_side(sizes.where("split").select("cell")), "cell", "left_semi")
        distinct = inside.groupBy("cell", F.xxhash64("vec").alias("h")).agg(F.min("vec").alias("vec"))
        w = Window.partitionBy("cell").orderBy("h")
        chosen = distinct.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= fan)
        pivots = chosen.select(F.col("cell").alias("parent"), F.concat_ws("/", F.col("cell"), F.col("place").cast("string")).alias("cell"), "vec")
        pivots = _stored(pivots, f"pivots{level}")
        moved = _down(inside.withColumn("bound", F.lit(None).cast("double")), pivots.withColumn("radius", F.lit(0.0)))
        rows = _stored(inside.drop("cell", "d").join(moved, "key"), f"rows{level + 1}")
        level += 1


_OUT = "test_id long, rep int, train_id long, nb_label long, dist double"
_NAMES = ["test_id", "rep", "train_id", "nb_label", "dist"]


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ids, labels, vectors, folds = None, [], None, None, None, None
        for batch in batches:
            cell, part, copy, kind = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "part", "copy", "kind"))
            cuts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (copy[1:] != copy[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(cuts, np.r_[cuts[1:], batch.num_rows], strict=True):
                if at != (cell[a], part[a], copy[a]):
                    at, held, ids = (cell[a], part[a], copy[a]), [], None
                rows = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(rows)
                    continue
                if ids is None:
                    if not held:
                        continue
                    ids = np.concatenate([h.column("id").to_numpy() for h in held])
                    labels = np.concatenate([h.column("label").to_numpy() for h in held])
                    vectors = np.concatenate([_matrix(h.column("vec")) for h in held])
                    folds = np.concatenate([np.array(h.column("folds").to_pylist(), np.int64).reshape(len(h), -1) for h in held])
                for i in range(0, len(rows), BATCH):
                    yield from found(rows.slice(i, BATCH), ids, labels, vectors, folds)

    def found(rows, ids, labels, vectors, folds):
        d = np.round(_distances(_matrix(rows.column("vec")), vectors), DIGITS)
        rep, own = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("rep", "fold"))
        bound = rows.column("bound").to_numpy(zero_copy_only=False)
        out = []
        for i, test in enumerate(rows.column("id").to_numpy()):
            ok = d[i] <= bound[i] + SLACK
            if rep[i] >= 0:
                ok &= folds[:, rep[i]] != own[i]
            near = np.flatnonzero(ok)
            near = near[np.lexsort((ids[near], d[i][near]))[:k]]
            out += [(int(test), int(rep[i]), int(ids[j]), int(labels[j]), float(d[i][j])) for j in near]
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=_NAMES)

    return run


def _search(train: DataFrame, test: DataFrame, k: int) -> DataFrame:
    """The best of each test row in its part; a part that many test rows are sent to is held by several tasks."""
    copies = test.groupBy("cell", "part").agg(F.ceil(F.count("*") / SEARCH_ROWS).cast("int").alias("copies"))
    copies = small_side(_stored(copies, "copies"))
    none = F.lit(None)
    held = train.join(copies, ["cell", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    rows = held.select("cell", "part", "copy", F.lit(0).alias("kind"), "id", "label", "vec", "folds", none.cast("int").alias("rep"), none.cast("int").alias("fold"), none.cast("double").alias("bound"))
    sent = test.join(copies, ["cell", "part"]).withColumn("copy", F.pmod(F.xxhash64("id", "rep"), F.col("copies")).cast("int"))
    rows = rows.unionByName(sent.select("cell", "part", "copy", F.lit(1).alias("kind"), "id", none.cast("long").alias("label"), "vec", none.cast("array<int>").alias("folds"), "rep", "fold", "bound"))
    return rows.repartition(_tasks(test), "cell", "part", "copy").sortWithinPartitions("cell", "part", "copy", "kind").mapInArrow(_searcher(k), _OUT)


def _reached(test: DataFrame, cells: DataFrame | None, levels: int, reach: bool) -> DataFrame:
    """``(key, cell, parts)``: the leaf that each test row ``(key, vec, bound)`` is nearest to level by
    level or, with ``reach``, all leaves within its bound."""
    at = test.select("key", F.lit("").alias("cell"))
    ended = None
    for level in range(levels):
        own = _stored(cells.where(F.col("level") == level + 1), f"level{level}")
        moved = _down(at.join(test.select("key", "vec", "bound"), "key"), own, reach)
        moved = _stored(moved.join(small_side(own.select("cell", "leaf", "parts")), "cell"), f"moved{level}")
        leaf = moved.where("leaf").select("key", "cell", "parts")
        ended = leaf if ended is None else ended.unionByName(leaf)
        at = moved.where("NOT leaf").select("key", "cell")
    return ended


def nearest(train: DataFrame, test: DataFrame, k: int, cell_rows: int = CELL_ROWS, fan: int = FAN) -> DataFrame:
    """The ``k`` nearest training rows of each test row by (distance, id):
    ``test_id, rep, train_id, nb_label, dist, rank``.

    ``train(id, label, vec, folds)``; ``test(id, vec, rep, fold)``.  If a test row
    has ``rep >= 0``, training rows with ``folds[rep] = fold`` are left out for it.
    """
    return _ranked(searched(train, test, k, cell_rows, fan)[0], k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("test_id", "rep").orderBy("dist", "train_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def searched(train: DataFrame, test: DataFrame, k: int, cell_rows: int = CELL_ROWS, fan: int = FAN) -> tuple[DataFrame, DataFrame | None]:
    """The best of each test row in each part it was sent to, and the later sends
    ``(key, cell, part)`` beyond its first part; none if one part holds all."""
    placed, cells, levels = _tree(train, cell_rows, fan)
    infinite = F.lit(float("inf"))
    if not levels:  # all in one cell, in parts only if its vectors are equal
        parts = placed.agg(F.max("parts")).first()[0] or 1
        whole = test.withColumns({"cell": F.lit(""), "bound": infinite, "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))})
        return _search(placed, whole, k), None
    test = _stored(test.withColumns({"key": F.monotonically_increasing_id(), "bound": infinite}), "test")
    home = _reached(test, cells, levels, False).select("key", "cell", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"))
    home = _stored(home, "home")
    first = _stored(_search(placed, test.join(home, "key"), k), "first")
    kth = first.groupBy("test_id", "rep").agg(F.count("*").alias("n"), F.max("dist").alias("bound")).filter(F.col("n") >= k)
    bounded = test.drop("bound").join(kth.select(F.col("test_id").alias("id"), "rep", "bound"), ["id", "rep"], "left").withColumn("bound", F.coalesce("bound", infinite))
    bounded = _stored(bounded, "bounded")
    sends = _reached(bounded, cells, levels, True).select("key", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    sends = _stored(sends.join(home, ["key", "cell", "part"], "left_anti"), "sends")
    return first.unionByName(_search(placed, bounded.join(sends, "key"), k)), sends


def _vote(neighbours: DataFrame, by: list[str]) -> DataFrame:
    """Majority label of each group; ties go to the label of the nearest."""
    votes = neighbours.groupBy(*by, "nb_label").agg(F.count("*").alias("votes"), F.min("rank").alias("nearest"))
    return votes.groupBy(*by).agg(F.max_by("nb_label", F.struct("votes", -F.col("nearest"))).alias("knn_label"))


def knn(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec", label_col: str = "label", cell_rows: int = CELL_ROWS) -> DataFrame:
    """k-NN majority vote (Euclidean; ties to the nearer, then the smaller id):
    ``id_col, knn_label`` for every test row, if there is a training row."""
    vec = F.col(vec_col).cast("array<double>").alias("vec")
    tr = train.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec, F.array().cast("array<int>").alias("folds"))
    te = test.select(F.col(id_col).cast("long").alias("id"), vec, F.lit(-1).alias("rep"), F.lit(-1).alias("fold"))
    return _vote(nearest(tr, te, k, cell_rows), ["test_id"]).select(F.col("test_id").alias(id_col), "knn_label")


def fold_of(key: Column, rep: int, folds: int) -> Column:
    """Fold number from the md5 of the key and the repeat."""
    text = F.concat_ws("|", key.cast("string"), F.lit(str(rep)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def knn_cv(df: DataFrame, ks: list[int], folds: int = 10, repeats: int = 3, id_col: str = "id", vec_col: str = "vec", label_col: str = "label") -> DataFrame:
    """Repeated k-fold accuracy of k-NN for every k in ``ks``: ``k, accuracy, n``.

    Each row is a test row of its own fold, once a repeat; neighbours are found once
    at the largest k, and the ranked beginning gives every smaller one.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"),
                     F.array(*[fold_of(F.col(id_col), r, folds) for r in range(repeats)]).alias("folds"))
    test = rows.select("id", "vec", F.posexplode("folds").alias("rep", "fold"))
    top = nearest(rows, test, max(ks))
    wide = top.withColumn("k", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))))
    voted = _vote(wide, ["test_id", "rep", "k"]).join(rows.select(F.col("id").alias("test_id"), "label"), "test_id")
    return voted.groupBy("k").agg(F.avg((F.col("knn_label") == F.col("label")).cast("double")).alias("accuracy"), F.count("*").alias("n")).orderBy("k")
