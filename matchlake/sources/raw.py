"""Raw API payloads: schemas, building, landing, reading, flattening.

Landing layout.  The reference writes one pretty-printed document per key
(``raw/fixtures/<date>/<date>.json``); a whole day then has to be gathered
into one record first.  We land compact JSON *lines* instead, one response
per line, partitioned by a key folder (``month=...``, ``league=...``).  A
folder holds the same responses as the reference's file, no group is ever
collected into one record, files split across tasks, and the key folder
gives partition pruning.  ``read_raw(..., multiline=True)`` still reads
pretty single-document files (each file must hold exactly one top-level
value -- Spark reads only the first one).

Schemas are explicit (no inference pass); malformed text lands in
``_corrupt_record`` under PERMISSIVE mode and is reported, not fatal.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.scalar import item

L, S = T.LongType(), T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CORRUPT = "_corrupt_record"

FIXTURE_ITEM = _st(
    ("fixture", _st(("id", L), ("referee", S), ("status", _st(("short", S))), ("venue", _st(("id", L))))),
    ("goals", _st(("away", L), ("home", L))),
    ("league", _st(("id", L), ("season", L))),
    ("teams", _st(("away", _st(("id", L))), ("home", _st(("id", L))))),
)
FIXTURES_SCHEMA = _st(("parameters", _st(("date", S))), ("response", T.ArrayType(FIXTURE_ITEM)),
                      (CORRUPT, S))

STAT_ENTRY = _st(("type", S), ("value", S))
STATS_DATA = _st(
    ("parameters", _st(("fixture", S))),
    ("response", T.ArrayType(_st(("team", _st(("id", L))), ("statistics", T.ArrayType(STAT_ENTRY))))),
)
FIXTURE_STATS_SCHEMA = _st(("Date", S), ("Data", STATS_DATA), (CORRUPT, S))

STANDING_ROW = _st(("rank", L), ("team", _st(("id", L))),
                   ("all", _st(("played", L), ("win", L), ("lose", L), ("draw", L))))
LEAGUE_TABLE = _st(("id", L), ("season", L), ("standings", T.ArrayType(T.ArrayType(STANDING_ROW))))
STANDING_SCHEMA = _st(("response", T.ArrayType(_st(("league", LEAGUE_TABLE)))), (CORRUPT, S))
STINT = _st(("team", _st(("id", L))), ("start", S), ("end", S))
COACH_SCHEMA = _st(("response", T.ArrayType(_st(("id", L), ("career", T.ArrayType(STINT))))), (CORRUPT, S))
SCHEMAS = {"fixtures": FIXTURES_SCHEMA, "fixture-stats": FIXTURE_STATS_SCHEMA,
           "standing": STANDING_SCHEMA, "coach": COACH_SCHEMA}

# Positions of the statistics the loader reads, and the type
# names of the statistics array as the API returns it.
STAT_POSITIONS = {"total_shots": 2, "fouls": 6, "possession": 9, "red_cards": 11,
                  "gk_saves": 12, "tot_passes": 13, "a_passes": 14}
STAT_TYPES = ["Shots on Goal", "Shots off Goal", "Total Shots", "Blocked Shots", "Shots insidebox",
              "Shots outsidebox", "Fouls", "Corner Kicks", "Offsides", "Ball Possession",
              "Yellow Cards", "Red Cards", "Goalkeeper Saves", "Total passes", "Passes accurate",
              "Passes %"]


# ---------------------------------------------------------------- reading

def read_raw(spark: SparkSession, path: str, kind: str, multiline: bool = False) -> DataFrame:
    """Read landed payloads of one kind with its explicit schema.

    ``path`` may be a folder tree (partition folders become columns) or a glob.
    """
    r = spark.read.schema(SCHEMAS[kind]).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT)
    if multiline:
        r = r.option("multiLine", True)
    return r.json(path)


def good_records(raw: DataFrame) -> DataFrame:
    """Rows that parsed (the corrupt-record column is NULL)."""
    return raw.where(F.col(CORRUPT).isNull()) if CORRUPT in raw.columns else raw


def bad_records(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def valid_json(df: DataFrame, col: str = "value", pretty: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split text records into (good, bad).  With ``pretty``, good rows are
    re-indented the way the extractor writes its files, all their fields and
    NULLs included; bad rows are returned for reporting instead of failing the
    job."""
    parsed = df.withColumn("__pretty", pretty_json(F.col(col)))
    good = parsed.where(F.col("__pretty").isNotNull())
    good = good.withColumn(col, F.col("__pretty")) if pretty else good
    return good.drop("__pretty"), parsed.where(F.col("__pretty").isNull()).drop("__pretty")


_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+')


def indented(text: str, step: str = "  ") -> str:
    """A JSON text laid out with one member or element to a line.  Only white space
    changes: names, their order, numbers and NULLs stay as written."""
    out, depth, opened = [], 0, False
    for m in _JSON_TOKEN.finditer(text):
        token = m[0]
        closes = token in ("}", "]")
        depth -= closes
        if opened != closes and out:  # a first member, or the end of what is not empty
            out.append("\n" + step * depth)
        opened = token in ("{", "[")
        depth += opened
        out.append(token)
        if token == ",":
            out.append("\n" + step * depth)
        elif token == ":":
            out.append(" ")
    return "".join(out)


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def pretty_json(c: Column) -> Column:
    """A column of JSON texts, indented; NULL where the text is not one JSON value.

    Marked as not deterministic, so that Spark evaluates it once where a filter and a projection
    both read it, and not in two Python workers of a task.
    """

    def one(text: str | None) -> str | None:
        try:
            json.loads(text or "", parse_constant=_no_constant)
        except (ValueError, RecursionError):
            return None
        return indented(text)

    @F.pandas_udf(T.StringType())
    def udf(texts: pd.Series) -> pd.Series:
        pa.default_memory_pool().release_unused()  # what earlier batches took goes back to the system
        return texts.map(one)

    return udf.asNondeterministic()(c)


def ok_responses(df: DataFrame, error_col: str = "error") -> DataFrame:
    """Drop calls that failed in transport (HTTP status is not examined, so
    error bodies pass and are dropped later by the inner explode)."""
    return df.where(F.col(error_col).isNull())


# ---------------------------------------------------------------- flattening

def explode_response(raw: DataFrame, *carry: Column | str, field: str = "response") -> DataFrame:
    """One row per element of the response array; empty/NULL arrays (a file
    holding ``null``, an error body) give no row -- inner explode."""
    return good_records(raw).select(*carry, F.explode(F.col(field)).alias("r"))


def bronze_fixture(raw: DataFrame, *carry: str) -> DataFrame:
    """Matches of fixtures payloads; ``carry`` names further columns to keep."""
    x = explode_response(raw, *carry, F.col("parameters.date").alias("fixture_date"))
    return x.select(
        *carry,
        "fixture_date",
        F.col("r.fixture.id").alias("fixture_id"),
        F.col("r.fixture.referee").alias("referee"),
        F.col("r.fixture.status.short").alias("status"),
        F.col("r.fixture.venue.id").alias("venue_id"),
        F.col("r.goals.away").alias("away_goals"),
        F.col("r.goals.home").alias("home_goals"),
        F.col("r.league.id").alias("league_id"),
        F.col("r.league.season").alias("season"),
        F.col("r.teams.away.id").alias("away_team_id"),
        F.col("r.teams.home.id").alias("home_team_id"),
    )


def bronze_fixture_stat(raw: DataFrame, *carry: str, by_name: bool = False) -> DataFrame:
    """Statistics by array position (reference behaviour; a short array gives
    NULLs), or by ``type`` name when ``by_name``."""
    x = explode_response(raw, *carry, F.col("Data.parameters.fixture").try_cast("bigint").alias("fixture_id"),
                         field="Data.response")
    stats = F.col("r.statistics")
    if by_name:
        def pick(name: str) -> Column:
            hit = F.filter(stats, lambda s: s["type"] == F.lit(name))
            return item(hit, 0, "value")
        vals = {k: pick(STAT_TYPES[p]) for k, p in STAT_POSITIONS.items()}
    else:
        vals = {k: item(stats, p, "value") for k, p in STAT_POSITIONS.items()}
    order = ["total_shots", "possession", "red_cards", "gk_saves", "fouls", "tot_passes", "a_passes"]
    return x.select(*carry, "fixture_id", F.col("r.team.id").alias("team_id"), *[vals[k].alias(k) for k in order])


def bronze_standings(raw: DataFrame, *carry: str, group: int = 0) -> DataFrame:
    """Rows of one standings group (the reference reads group 0 only)."""
    x = explode_response(raw, *carry)
    x = x.select(*carry, F.col("r.league").alias("lg"),
                 F.explode(item(F.col("r.league.standings"), group)).alias("s"))
    return x.select(
        *carry, F.col("lg.id").alias("league_id"), F.col("lg.season").alias("season"),
        F.col("s.rank").alias("rank"), F.col("s.team.id").alias("team_id"),
        F.col("s.all.played").alias("played"), F.col("s.all.win").alias("won"),
        F.col("s.all.lose").alias("lost"), F.col("s.all.draw").alias("draw"),
    )


def bronze_coach(raw: DataFrame, *carry: str) -> DataFrame:
    x = explode_response(raw, *carry)
    x = x.select(*carry, F.col("r.id").alias("coach_id"), F.explode("r.career").alias("c"))
    return x.select(*carry, "coach_id", F.col("c.team.id").alias("team_id"),
                    F.col("c.start").alias("start_date"), F.col("c.end").alias("end_date"))


def payload_ids(raw: DataFrame) -> DataFrame:
    """Fixture ids named in fixtures payloads (what the stats requests need)."""
    return good_records(raw).select(F.explode(F.col("response.fixture.id")).alias("fixture_id"))


def standing_team_ids(raw: DataFrame) -> DataFrame:
    """Unique team ids over *all* standings groups (the extractor's view)."""
    rows = good_records(raw).select(F.explode("response").alias("r")) \
        .select(F.explode(F.flatten("r.league.standings")).alias("s"))
    return rows.select(F.col("s.team.id").alias("team_id")).distinct()


# ---------------------------------------------------------------- building payloads

def fixture_payloads(bronze_fix: DataFrame) -> DataFrame:
    """(date, value) lines shaped like the fixtures API answer, one match per line."""
    resp = F.struct(
        F.struct(F.col("fixture_id").alias("id"), F.col("referee").alias("referee"),
                 F.struct(F.col("status").alias("short")).alias("status"),
                 F.struct(F.col("venue_id").alias("id")).alias("venue")).alias("fixture"),
        F.struct(F.col("away_goals").alias("away"), F.col("home_goals").alias("home")).alias("goals"),
        F.struct(F.col("league_id").alias("id"), F.col("season").alias("season")).alias("league"),
        F.struct(F.struct(F.col("away_team_id").alias("id")).alias("away"),
                 F.struct(F.col("home_team_id").alias("id")).alias("home")).alias("teams"),
    )
    doc = F.struct(F.struct(F.col("fixture_date").alias("date")).alias("parameters"),
                   F.array(resp).alias("response"))
    return bronze_fix.select(F.col("fixture_date").alias("date"), F.to_json(doc).alias("value"))


def stat_payloads(bronze_stat: DataFrame, fixture_dates: DataFrame) -> DataFrame:
    """(date, value) lines ``{"Date":..., "Data": <statistics answer>}``, one
    match per line."""
    return stat_lines(stat_rows(bronze_stat, fixture_dates))


def stat_rows(bronze_stat: DataFrame, fixture_dates: DataFrame) -> DataFrame:
    """(date, fixture_id, teams): the team rows of a match, combined with a bounded
    (two-element) ``collect_list`` per fixture.  Only the values are moved and sorted: the
    names of the statistics are the same in every row, many times as long as the values, and
    vanish in compressed shuffles but not in a task's memory."""
    in_place = sorted(STAT_POSITIONS, key=STAT_POSITIONS.get)  # the order in which whole entries compare
    per_fixture = bronze_stat.groupBy("fixture_id").agg(F.sort_array(F.collect_list(F.struct("team_id", *in_place))).alias("teams"))
    return per_fixture.join(fixture_dates.select("fixture_id", F.col("fixture_date").alias("date")), "fixture_id").select("date", "fixture_id", "teams")


def stat_lines(rows: DataFrame, *carry: str) -> DataFrame:
    """The payload line of each of ``stat_rows``: (date, value), or ``carry`` in place of the date."""
    by_pos = {p: k for k, p in STAT_POSITIONS.items()}

    def team(e: Column) -> Column:
        entries = [F.struct(F.lit(name).alias("type"), (e[by_pos[i]] if i in by_pos else F.lit(None).cast("string")).alias("value"))
                   for i, name in enumerate(STAT_TYPES)]
        return F.struct(F.struct(e["team_id"].alias("id")).alias("team"), F.array(*entries).alias("statistics"))

    data = F.struct(F.struct(F.col("fixture_id").cast("string").alias("fixture")).alias("parameters"),
                    F.transform("teams", team).alias("response"))
    return rows.select(*(carry or ("date",)), F.to_json(F.struct(F.col("date").alias("Date"), data.alias("Data"))).alias("value"))


def standing_payloads(bronze_st: DataFrame) -> DataFrame:
    """(league, season, value): one document per league-season with one
    standings group; the group holds that league's teams (bounded by the
    league size, not by data volume)."""
    row = F.struct(F.col("rank").alias("rank"), F.struct(F.col("team_id").alias("id")).alias("team"),
                   F.struct(F.col("played").alias("played"), F.col("won").alias("win"),
                            F.col("lost").alias("lose"), F.col("draw").alias("draw")).alias("all"))
    g = bronze_st.groupBy("league_id", "season").agg(F.sort_array(F.collect_list(
        F.struct(F.col("rank").alias("k"), row.alias("v")))).alias("rows"))
    doc = F.struct(F.array(F.struct(F.struct(
        F.col("league_id").alias("id"), F.col("season").alias("season"),
        F.array(F.transform("rows", lambda e: e["v"])).alias("standings")).alias("league"))).alias("response"))
    return g.select(F.col("league_id").alias("league"), "season", F.to_json(doc).alias("value"))


def coach_payloads(bronze_co: DataFrame) -> DataFrame:
    """(team, value): one coach answer per line with that coach's stint."""
    career = F.struct(F.struct(F.col("team_id").alias("id")).alias("team"),
                      F.col("start_date").alias("start"), F.col("end_date").alias("end"))
    doc = F.struct(F.array(F.struct(F.col("coach_id").alias("id"), F.array(career).alias("career")))
                   .alias("response"))
    return bronze_co.select(F.col("team_id").alias("team"), F.to_json(doc).alias("value"))


# ---------------------------------------------------------------- landing

def by_month(payloads: DataFrame, date_col: str = "date") -> DataFrame:
    """Use the month as landing folder key (the record keeps its date).  One
    folder per day makes thousands of tiny files per season; a month folder
    keeps date -> folder pruning with far fewer, larger files."""
    return payloads.select(F.substring(F.col(date_col), 1, 7).alias("month"), "value")


def land(payloads: DataFrame, path: str, keys: list[str], mode: str = "overwrite", lines: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write payload lines under one folder per key (dynamic partition
    overwrite: only the keys present in ``payloads`` are replaced).  ``lines`` makes the lines from
    ``payloads`` after these are shuffled and sorted, where lines are much larger."""
    # REBALANCE: AQE groups rows of a key into few files and still splits a
    # hot key over several tasks (skewed-partition splitting), instead of
    # every task writing one small file into every key folder.
    grouped = payloads.hint("rebalance", *keys)
    grouped = lines(grouped.sortWithinPartitions(*keys)) if lines else grouped
    (grouped.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).text(path))
