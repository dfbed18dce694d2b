"""Row-count rolling means (the gold features).

``rolling_mean`` computes AVG over ``ROWS BETWEEN n PRECEDING AND 1 PRECEDING``
per key in a given order.  Two physical strategies, same result:

* ``chunk=None`` -- one Spark window per key.  Every row of a key goes to one
  task; fine while keys are many and small (real leagues: ~40 matches per team
  and season).
* ``chunk=<column>`` -- split each key into ordered chunks (e.g. the match
  month) and run the window per (key, chunk); ``chunk="balanced"`` makes chunks of a
  bounded number of rows, however a key's rows lie in time, of the keys that need it.  A row whose frame reaches into
  earlier chunks needs at most ``n`` rows from them, its chunk's *halo*.  Halo
  rows come from the last ``n`` rows of the earlier chunks (``row_number <= n``,
  which Spark limits on the map side); a row with reverse rank ``r`` goes to a
  later chunk only if ``r`` plus the rows of the chunks in between is at most
  ``n``, so a chunk gets at most ``n`` halo rows.  The rows in between are known
  from the (key, chunk) counts, a grouped aggregation.  A hot key (a third of all
  rows) is spread over as many tasks as it has chunks.  The (key, chunk) table
  is windowed by key, so a key's chunks (one narrow row each) meet in one task.

Frame semantics follow SQL: NULLs inside a frame are skipped, an empty or
all-NULL frame gives NULL.  ``direction='desc'`` reproduces the reference's
forward-looking frame (the mean of the *next* n matches); ``'asc'`` is the
leak-free form (the mean of the previous n matches).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.joins import small_side

CHUNK_ROWS = 16384  # rows that a balanced chunk aims at


def _order(cols: Sequence[str], direction: str) -> list[Column]:
    if direction not in ("asc", "desc"):
        raise ValueError("direction must be 'asc' or 'desc'")
    return [F.col(c).desc() if direction == "desc" else F.col(c).asc() for c in cols]


def _reverse(cols: Sequence[str], direction: str) -> list[Column]:
    return _order(cols, "asc" if direction == "desc" else "desc")


def balanced(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = CHUNK_ROWS) -> tuple[DataFrame, Column] | None:
    """``df`` with the parts of a chunk column, and that column, so that a key's chunks hold about
    ``rows`` rows and at most a few times as many; None if no key has more than ``rows``.

    A chunk's number is the count of the key's rows before it, over ``rows``.  The counts are by
    (key, first order column); a value that alone has more than ``rows`` rows (a day of
    a hot key) is counted on by the next order column, and so on.  Only keys of more than
    ``rows`` rows are counted.
    """
    keys, order = list(keys), list(order)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows).select(*keys)
    if not large.limit(1).count():
        return None
    counted, out, parts = df.join(small_side(large), keys, "left_semi"), df, []
    for depth, name in enumerate(order):
        by = keys + order[:depth + 1]
        w = Window.partitionBy(*keys, *order[:depth]).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        here = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("__m")).withColumn("__before", F.coalesce(F.sum("__m").over(w), F.lit(0)))
        out = out.join(small_side(here.select(*by, F.floor(F.col("__before") / rows).alias(f"__part{depth}"))), by, "left")
        parts.append(F.coalesce(f"__part{depth}", F.lit(0)).alias(f"p{depth}"))
        heavy = here.where(F.col("__m") > rows).select(*by)
        if depth + 1 == len(order) or not heavy.limit(1).count():
            break
        counted = counted.join(small_side(heavy), by, "left_semi")
    return out, F.struct(*parts)


def rolling_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 specs: Sequence[tuple[str, Column, int]], direction: str = "desc",
                 chunk: Column | str | None = None, keep: Sequence[str] | None = None,
                 store: Callable[[DataFrame], DataFrame] | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``AVG(expr) OVER (PARTITION BY keys ORDER BY order <direction>
    ROWS BETWEEN n PRECEDING AND 1 PRECEDING)`` for each ``(name, expr, n)``.

    ``order`` must make rows unique within a key (add an id as tie-break).
    ``chunk`` must be monotone in ``order`` (rows of an earlier chunk come
    first in the same direction); e.g. the date when ordering by (date, id).
    ``chunk="balanced"`` chunks by counts (``balanced``, of ``chunk_rows``); the input is then
    read several times, and ``store`` may write it once before.
    ``keep`` lists the output columns (default: all input columns + specs).
    """
    keys, order = list(keys), list(order)
    out_cols = list(keep) if keep is not None else list(df.columns)
    names = [s[0] for s in specs]
    if isinstance(chunk, str):
        if chunk != "balanced":
            raise ValueError("chunk must be a column, 'balanced' or None")
        needed = [*dict.fromkeys([*keys, *order, *out_cols])]
        df = df.select(*needed, *[e.alias(f"__in{i}") for i, (_, e, _) in enumerate(specs)])
        specs = [(name, F.col(f"__in{i}"), n) for i, (name, _, n) in enumerate(specs)]
        df = store(df) if store else df
        found = balanced(df, keys, order, chunk_rows)
        df, chunk = found if found else (df, None)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, direction))
        return df.select(*out_cols, *[F.avg(e).over(w.rowsBetween(-n, -1)).alias(name)
                                      for name, e, n in specs])

    n_max = max(n for _, _, n in specs)
    vals = [e.alias(f"__v{i}") for i, (_, e, _) in enumerate(specs)]
    part = keys + ["__chunk"]
    rows = df.select(*keys, *[c for c in dict.fromkeys(order + out_cols) if c not in keys],
                     chunk.alias("__chunk"), *vals)
    # the only exchange of all rows; the union keeps its partitioning, so the
    # final window adds none
    base = rows.repartition(*part)

    # the last n rows (in frame order) of every chunk: candidates for the halo.
    # Not taken from ``base``: before its own exchange Spark limits them to n rows
    # of a chunk in each task
    tail_w = Window.partitionBy(*part).orderBy(*_reverse(order, direction))
    tail = rows.withColumn("__rn", F.row_number().over(tail_w)).where(F.col("__rn") <= n_max)

    # for every chunk the next n chunks (in frame order), each with the number
    # of rows between: counts are combined map-side, one row per (key, chunk)
    counts = df.groupBy(*keys, chunk.alias("__chunk")).agg(F.count(F.lit(1)).alias("__n"))
    wk = Window.partitionBy(*keys).orderBy(
        F.col("__chunk").desc() if direction == "desc" else F.col("__chunk").asc())
    targets, between = [], F.lit(0).cast("bigint")
    for j in range(1, n_max + 1):
        targets.append(F.struct(F.lead("__chunk", j).over(wk).alias("chunk"), between.alias("between")))
        between = between + F.lead("__n", j).over(wk)
    nexts = counts.select(*part, F.array(*targets).alias("__targets"))
    # a tail row goes to the chunks whose frames can reach it, and to no others
    t = tail.join(nexts, part)
    reached = F.filter("__targets", lambda x: x["chunk"].isNotNull() & (x["between"] + F.col("__rn") <= n_max))
    halo = t.select(*[c for c in base.columns if c != "__chunk"], F.explode(reached).alias("__t")) \
        .select("*", F.col("__t.chunk").alias("__chunk")) \
        .withColumn("__halo", F.lit(True)).select(*base.columns, "__halo").repartition(*part)

    every = base.withColumn("__halo", F.lit(False)).unionByName(halo)
    w = Window.partitionBy(*part).orderBy(*_order(order, direction))
    res = every.select(
        *out_cols, "__halo",
        *[F.avg(F.col(f"__v{i}")).over(w.rowsBetween(-n, -1)).alias(name)
          for i, (name, _, n) in enumerate(specs)],
    )
    return res.where(~F.col("__halo")).select(*out_cols, *names)
