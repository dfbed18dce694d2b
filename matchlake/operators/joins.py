"""Join operators of the gold layer.

All joins here have an equality key, and their build sides are dimension-sized
(standings: teams x seasons, coaches: teams x stints).  ``small_side`` checks that
size on the data before it broadcasts one, so that the fact side is not shuffled
on a key of few values; a larger side stays a shuffled join, whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.scalar import within


BROADCAST_ROWS = 200_000  # of a few numbers and short texts: some 20 MB


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``max_rows`` rows, else as it
    is.  Counting reads no more than one row beyond; callers pass narrow rows of
    bounded width (ids, ranks, dates), from a stored table where it is costly to
    derive."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def prior_standing(standings: DataFrame) -> DataFrame:
    """``SELECT DISTINCT season, team_id, rank AS prior_season_rank``."""
    return standings.select("season", "team_id", F.col("rank").alias("prior_season_rank")).distinct()


def prior_season_join(df: DataFrame, standing: DataFrame, team_col: str = "team_id",
                      season_col: str = "season") -> DataFrame:
    """Offset-key join: each row gets the rank its ``team_col`` had the season before.

    The derived key ``season - 1`` is computed on the probe side, so this is a
    plain equi-join on (season, team).  Rows without a prior-season rank drop
    (inner join); a team ranked twice in one season multiplies rows.
    """
    s = standing.select(F.col("season").alias("__prior"), F.col("team_id").alias("__team"),
                        "prior_season_rank")
    j = df.join(small_side(s), (F.col(season_col) - 1 == F.col("__prior")) & (F.col(team_col) == F.col("__team")))
    return j.drop("__prior", "__team")


def coach_on_date(fx: DataFrame, coach: DataFrame, team_col: str, date_col: str = "fixture_date",
                  out: str = "coach_id") -> DataFrame:
    """Interval join: the coach(es) of ``team_col`` whose stint covers the date.

    Equality on team is the hashed join key; the inclusive date range is the
    residual condition.  A NULL start date never matches; overlapping stints
    all match (rows multiply, as in the reference).
    """
    c = coach.select(F.col("team_id").alias("__team"), F.col("start_date").alias("__start"),
                     F.col("calc_end_date").alias("__end"), F.col("coach_id").alias(out))
    cond = (F.col(team_col) == F.col("__team")) & within(date_col, "__start", "__end")
    return fx.join(small_side(c), cond).drop("__team", "__start", "__end")


def to_team_rows(fx: DataFrame, home: list[Column], away: list[Column], keep: list[str] = []) -> DataFrame:
    """Un-pivot a match row into a home row and an away row in one scan.

    ``home`` / ``away`` are aliased column lists with the same names; ``keep`` are columns
    of the match that come first in both (rows partitioned by them stay so).
    """
    return fx.select(*keep, F.inline(F.array(F.struct(*home), F.struct(*away))))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION`` (distinct) by column name."""
    return a.unionByName(b).distinct()
