"""Silver layer: clean, cast, label and keep known leagues/teams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.scalar import calc_end, match_result, null_default, pct_to_double, to_double
from matchlake.operators.joins import small_side


def known(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """``col IN (SELECT DISTINCT col FROM ids)`` as a left-semi join.

    The id list is reduced to distinct values first (a partial+final
    aggregate) and broadcast if its checked size allows, so the table itself is
    not shuffled on a key of few values.
    """
    return df.join(small_side(ids.select(col).distinct()), col, "left_semi")


def silver_fixture(bronze_fixture: DataFrame, bronze_standings: DataFrame) -> DataFrame:
    f = known(bronze_fixture, bronze_standings, "league_id").where(F.col("away_goals").isNotNull())
    return f.select(*bronze_fixture.columns, match_result().alias("match_result"))


def silver_standing(bronze_standings: DataFrame) -> DataFrame:
    return bronze_standings


def silver_fixture_stat(bronze_fixture_stat: DataFrame, bronze_standings: DataFrame) -> DataFrame:
    s = known(bronze_fixture_stat, bronze_standings, "team_id").where(F.col("total_shots").isNotNull())
    return s.select(
        "fixture_id", "team_id",
        to_double("total_shots").alias("total_shots"),
        pct_to_double("possession").alias("possession"),
        null_default(to_double("red_cards"), 0.0).alias("red_cards"),
        to_double("gk_saves").alias("gk_saves"),
        to_double("fouls").alias("fouls"),
        to_double("tot_passes").alias("tot_passes"),
        to_double("a_passes").alias("a_passes"),
    )


def silver_coach(bronze_coach: DataFrame) -> DataFrame:
    c = bronze_coach.where(F.col("team_id").isNotNull())
    return c.select(*bronze_coach.columns, calc_end("end_date").alias("calc_end_date"))


SILVER = ("silver_fixture", "silver_standing", "silver_fixture_stat", "silver_coach")


def silver_tables(bronze: dict[str, DataFrame], needed: tuple[str, ...] = SILVER) -> dict[str, DataFrame]:
    """The named silver tables.  Pass standings from a stored table: three of the
    four read them."""
    st = bronze["bronze_standings"]
    make = {
        "silver_fixture": lambda: silver_fixture(bronze["bronze_fixture"], st),
        "silver_standing": lambda: silver_standing(st),
        "silver_fixture_stat": lambda: silver_fixture_stat(bronze["bronze_fixture_stat"], st),
        "silver_coach": lambda: silver_coach(bronze["bronze_coach"]),
    }
    return {name: make[name]() for name in needed}
