"""Projection of the driver's TPC-H-style tables onto the match domain.

The reference lands API payloads; the test harness gives parquet tables
instead.  These functions derive the four bronze tables from them with plain
DataFrame expressions so every downstream query grows with the input.  The
same projection is written in SQL in ``matchlake.oracle`` for the DuckDB check.

Fixed values of the projection (must stay equal on both sides):
  teams 40, leagues 4, venues 7; away team = (home + 4 * (1 + key % 9)) % 40;
  away goals = floor(price / 7) % 4, home goals = floor(price / 11) % 5,
  no goals for status 'P' (status text 'NS', otherwise 'FT');
  coach eras by nation % 3:
    0 -> 1994-01-01 .. 1996-06-30
    1 -> 1996-06-01 .. 1998-12-31   (overlaps era 0 in June 1996)
    2 -> 1999-01-01 .. open end
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_TEAMS = 40
N_LEAGUES = 4
N_VENUES = 7
COACH_ERAS = [
    ("1994-01-01", "1996-06-30"),
    ("1996-06-01", "1998-12-31"),
    ("1999-01-01", None),
]

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_date(c: Column) -> Column:
    """Timestamp/date -> 'yyyy-MM-dd' text (the reference keeps dates as text)."""
    return F.date_format(F.to_date(c), "yyyy-MM-dd")


def fixture_from_orders(orders: DataFrame) -> DataFrame:
    """bronze_fixture columns, one row per order."""
    pending = F.col("o_orderstatus") == F.lit("P")
    home = F.col("o_custkey") % N_TEAMS
    return orders.select(
        iso_date(F.col("o_orderdate")).alias("fixture_date"),
        F.col("o_orderkey").alias("fixture_id"),
        F.col("o_orderpriority").alias("referee"),
        F.when(pending, F.lit("NS")).otherwise(F.lit("FT")).alias("status"),
        (F.col("o_custkey") % N_VENUES).alias("venue_id"),
        F.when(pending, F.lit(None).cast("bigint"))
         .otherwise(F.floor(F.col("o_totalprice") / 7).cast("bigint") % 4).alias("away_goals"),
        F.when(pending, F.lit(None).cast("bigint"))
         .otherwise(F.floor(F.col("o_totalprice") / 11).cast("bigint") % 5).alias("home_goals"),
        (F.col("o_custkey") % N_LEAGUES).alias("league_id"),
        F.year("o_orderdate").cast("bigint").alias("season"),
        ((home + 4 * (1 + F.col("o_orderkey") % 9)) % N_TEAMS).alias("away_team_id"),
        home.alias("home_team_id"),
    )


def standings_from_fixture(fixture: DataFrame) -> DataFrame:
    """bronze_standings: one row per (league, season, team) with a table rank.

    Both sides of every played match become team rows in one scan
    (``inline`` of a two-element array), are summed with a partial+final
    aggregate, and ranked inside each league-season.  The rank window runs on
    the aggregated table (teams x seasons), never on match rows.
    """
    played = fixture.where(F.col("away_goals").isNotNull() & F.col("home_goals").isNotNull())
    a, h = F.col("away_goals"), F.col("home_goals")

    def side(team: str, gf: Column, ga: Column) -> Column:
        return F.struct(
            F.col(team).alias("team_id"),
            (gf > ga).cast("int").alias("won"),
            (gf < ga).cast("int").alias("lost"),
            (gf == ga).cast("int").alias("draw"),
        )

    rows = played.select(
        "league_id", "season",
        F.inline(F.array(side("home_team_id", h, a), side("away_team_id", a, h))),
    )
    table = rows.groupBy("league_id", "season", "team_id").agg(
        F.count(F.lit(1)).alias("played"),
        F.sum("won").cast("bigint").alias("won"),
        F.sum("lost").cast("bigint").alias("lost"),
        F.sum("draw").cast("bigint").alias("draw"),
    )
    w = Window.partitionBy("league_id", "season").orderBy(
        (3 * F.col("won") + F.col("draw")).desc(), F.col("team_id").asc())
    return table.select(
        "league_id", "season",
        F.row_number().over(w).cast("bigint").alias("rank"),
        "team_id", "played", "won", "lost", "draw",
    )


def fixture_stat_from_lineitem(lineitem: DataFrame, fixture: DataFrame) -> DataFrame:
    """bronze_fixture_stat: per (fixture, team) statistics as text, like the API.

    Line items are pre-aggregated per (order, side) before the join, so the
    join sees at most two rows per order.
    """
    side = (F.col("l_linenumber") % 2 == 0)
    per_side = lineitem.groupBy(
        F.col("l_orderkey").alias("fixture_id"), side.alias("is_home")
    ).agg(
        F.sum("l_quantity").alias("q_sum"),
        F.min("l_quantity").alias("q_min"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("reds"),
        F.count(F.lit(1)).alias("n"),
        F.max("l_linenumber").alias("max_line"),
    )
    fx = fixture.select("fixture_id", "home_team_id", "away_team_id")
    j = per_side.join(fx, "fixture_id")
    q_sum = F.col("q_sum").cast("bigint")
    return j.select(
        "fixture_id",
        F.when(F.col("is_home"), F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"),
        q_sum.cast("string").alias("total_shots"),
        F.concat((q_sum % 101).cast("string"), F.lit("%")).alias("possession"),
        F.nullif(F.col("reds"), F.lit(0)).cast("string").alias("red_cards"),
        F.col("n").cast("string").alias("gk_saves"),
        F.col("max_line").cast("string").alias("fouls"),
        q_sum.cast("string").alias("tot_passes"),
        F.col("q_min").cast("bigint").cast("string").alias("a_passes"),
    )


def coach_from_customer(customer: DataFrame) -> DataFrame:
    """bronze_coach: one coach per (team, era); the coach id is the smallest
    customer key of the group.  The output is bounded (teams x eras) whatever
    the size of ``customer``; partial aggregation keeps the shuffle tiny."""
    era = F.col("c_nationkey") % len(COACH_ERAS)
    start = F.when(era == 0, F.lit(COACH_ERAS[0][0])).when(era == 1, F.lit(COACH_ERAS[1][0])) \
        .otherwise(F.lit(COACH_ERAS[2][0]))
    end = F.when(era == 0, F.lit(COACH_ERAS[0][1])).when(era == 1, F.lit(COACH_ERAS[1][1])) \
        .otherwise(F.lit(None).cast("string"))
    g = customer.select(
        F.col("c_custkey"),
        (F.col("c_custkey") % N_TEAMS).alias("team_id"),
        start.alias("start_date"), end.alias("end_date"),
    ).groupBy("team_id", "start_date", "end_date").agg(F.min("c_custkey").alias("coach_id"))
    return g.select("coach_id", "team_id", "start_date", "end_date")


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four bronze tables projected from the driver parquet files."""
    orders = read_table(spark, sf_dir, "orders")
    fixture = fixture_from_orders(orders)
    return {
        "bronze_fixture": fixture,
        "bronze_standings": standings_from_fixture(fixture),
        "bronze_fixture_stat": fixture_stat_from_lineitem(read_table(spark, sf_dir, "lineitem"), fixture),
        "bronze_coach": coach_from_customer(read_table(spark, sf_dir, "customer")),
    }
