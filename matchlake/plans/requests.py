"""Request planning: which API calls to make, as DataFrames.

Everything stays a DataFrame expression: bounds are columns (never collected
to the driver), spines are ``sequence`` + ``explode`` per bounds row, and the
season x league plan is built per league from its own season range, so no
Cartesian product is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Request path templates and landing folder layout.
FIXTURES_BY_DATE = "fixtures?date=%s"
STATS_BY_FIXTURE = "fixtures/statistics?fixture=%d"
STANDINGS_BY_SEASON_LEAGUE = "standings?season=%s&league=%d"
COACH_BY_TEAM = "coachs?team=%d"
LANDING_PATHS = {
    "fixtures": "raw/fixtures/{date}/{date}.json",
    "fixture-stats": "raw/fixture-stats/{date}/{date}.json",
    "standing": "raw/standing/{league}/{season}.json",
    "coach": "raw/coach/{team}/{team}.json",
}
# The twelve league ids the standings extractor asks for.
LEAGUE_IDS = [39, 135, 78, 140, 61, 71, 492, 203, 497, 40, 128, 144]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_spine(bounds: DataFrame, start="start", end="end", out: str = "date") -> DataFrame:
    """Inclusive daily list per bounds row, as 'yyyy-MM-dd' text."""
    d = F.explode(F.sequence(F.to_date(_c(start)), F.to_date(_c(end)), F.expr("INTERVAL 1 DAY")))
    return bounds.select(d.alias("__d")).select(F.date_format("__d", "yyyy-MM-dd").alias(out))


def year_spine(bounds: DataFrame, start="start", end="end", out: str = "season") -> DataFrame:
    """Inclusive yearly list per bounds row (text or numeric years)."""
    y = F.explode(F.sequence(_c(start).try_cast("bigint"), _c(end).try_cast("bigint")))
    return bounds.select(y.alias(out))


def request_plan(leagues: DataFrame, league: str = "league_id", first: str = "first_season",
                 last: str = "last_season") -> DataFrame:
    """Season x league requests: each league row expands to every season in
    its own [first, last] range (one row per API call)."""
    return leagues.select(
        F.col(league).alias("league_id"),
        F.explode(F.sequence(_c(first), _c(last))).alias("season"),
    )


def render(df: DataFrame, template: str, *cols: str, out: str = "request") -> DataFrame:
    """Add the request text rendered from ``template`` (printf holes)."""
    return df.withColumn(out, F.format_string(template, *[F.col(c) for c in cols]))


def landing_path(kind: str, **keys: Column) -> Column:
    """Object path of a landed payload, e.g. ``landing_path('standing', league=..., season=...)``."""
    pattern = LANDING_PATHS[kind]
    parts: list[Column] = []
    rest = pattern
    while "{" in rest:
        pre, after = rest.split("{", 1)
        name, rest = after.split("}", 1)
        if pre:
            parts.append(F.lit(pre))
        parts.append(keys[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)
