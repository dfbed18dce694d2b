"""Gold layer: rolling team form, opponent difficulty, the per-match table.

Window order is the match date with ``fixture_id`` (and the rank) as
tie-breaks, so results are deterministic when a team plays twice on a day.
``direction='desc'`` is the reference's frame: it averages the team's *next*
matches (a forward-looking feature; the latest match has an empty frame).
``direction='asc'`` averages the previous matches (leak-free).

``chunk`` selects the rolling strategy (see ``operators.rolling``): by default
teams of many matches are split into chunks of a bounded number of rows, so a team
holding a large share of all matches, or all of them in one month, is still spread over many tasks, and
a chunk gets at most nine halo rows.  ``store`` writes the windows' input once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.scalar import ratio
from matchlake.operators.joins import coach_on_date, prior_season_join, prior_standing, to_team_rows
from matchlake.operators.rolling import rolling_mean

DEFAULT_CHUNK = "balanced"

FRAME = 9  # rows of the widest frame
FORM_SPECS = [  # (output, input expression, frame rows)
    ("total_shots_avg", "total_shots", 9),
    ("possession_avg", "possession", 9),
    ("red_cards", "red_cards", 4),
    ("gk_saves_avg", "gk_saves", 9),
    ("fouls_avg", "fouls", 9),
]


def _chunk(chunk):
    if chunk is None or chunk is False:
        return None
    if isinstance(chunk, str) and chunk == "month":
        return F.substring("fixture_date", 1, 7)
    return F.col(chunk) if isinstance(chunk, str) and chunk != "balanced" else chunk


FORM_INPUTS = ["total_shots", "possession", "red_cards", "gk_saves", "fouls", "a_passes", "tot_passes"]
ORDER = ["fixture_date", "fixture_id", "prior_season_rank"]


def team_stats_rows(silver_fixture: DataFrame, silver_standing: DataFrame, silver_fixture_stat: DataFrame) -> DataFrame:
    """The windows' input: a team's statistics in a match, with its date and the rank of the season before."""
    # dealt by match: one exchange serves the distinct and the join
    fixture_dates = silver_fixture.select("fixture_date", "fixture_id", "season").repartition("fixture_id").distinct()
    temp = silver_fixture_stat.join(fixture_dates, "fixture_id")
    temp = prior_season_join(temp, prior_standing(silver_standing), "team_id")
    return temp.select("team_id", *ORDER, *FORM_INPUTS)


def team_form(rows: DataFrame, keep: list[str], direction: str = "desc", chunk=DEFAULT_CHUNK, store=None) -> DataFrame:
    """Rolling form over ``team_stats_rows``; a row's averages need no more than the nine rows
    before it in frame order."""
    specs = [(name, F.col(src), n) for name, src, n in FORM_SPECS]
    specs.append(("pass_accuracy_avg", ratio("a_passes", "tot_passes"), FRAME))
    return rolling_mean(rows, ["team_id"], ORDER, specs, direction=direction, chunk=_chunk(chunk), keep=keep, store=store)


def gold_team_stats(silver_fixture: DataFrame, silver_standing: DataFrame,
                    silver_fixture_stat: DataFrame, direction: str = "desc",
                    chunk=DEFAULT_CHUNK, store=None) -> DataFrame:
    rows = team_stats_rows(silver_fixture, silver_standing, silver_fixture_stat)
    return team_form(rows, ["team_id", "fixture_id", "prior_season_rank"], direction, chunk, store)


def team_opponent_rows(silver_fixture: DataFrame, silver_standing: DataFrame) -> DataFrame:
    """Home view and away view of each match with the opponent's prior-season
    rank: the two CTEs of the reference built from one scan, then UNION-distinct."""
    # dealt by match and date: one exchange serves both distincts
    fd = silver_fixture.select("fixture_date", "fixture_id", "season", "away_team_id", "home_team_id").repartition("fixture_id", "fixture_date").distinct()
    rows = to_team_rows(
        fd, keep=["fixture_id", "fixture_date"],
        home=[F.col("home_team_id").alias("team_id"),
              F.col("season"), F.col("away_team_id").alias("opponent_id")],
        away=[F.col("away_team_id").alias("team_id"),
              F.col("season"), F.col("home_team_id").alias("opponent_id")],
    )
    rows = prior_season_join(rows, prior_standing(silver_standing), team_col="opponent_id")
    return rows.select("fixture_id", "team_id", "fixture_date", "season", "prior_season_rank").distinct()


def ranks_faced(rows: DataFrame, keep: list[str], direction: str = "desc", chunk=DEFAULT_CHUNK, store=None) -> DataFrame:
    """Rolling mean of the opponents' ranks over ``team_opponent_rows``."""
    return rolling_mean(rows, ["team_id"], ORDER, [("rank_team_faced", F.col("prior_season_rank").cast("double"), FRAME)],
                        direction=direction, chunk=_chunk(chunk), keep=keep, store=store)


def gold_avg_team_difficulty(silver_fixture: DataFrame, silver_standing: DataFrame,
                             direction: str = "desc", chunk=DEFAULT_CHUNK, store=None) -> DataFrame:
    combined = team_opponent_rows(silver_fixture, silver_standing)
    return ranks_faced(combined, ["fixture_id", "team_id"], direction, chunk, store)


TEAM_LEVEL_COLS = ["rank_team_faced", "total_shots_avg", "prior_season_rank", "possession_avg",
                   "red_cards", "gk_saves_avg", "fouls_avg", "pass_accuracy_avg"]


def team_level(team_stats: DataFrame, difficulty: DataFrame) -> DataFrame:
    d = difficulty.select("fixture_id", "team_id", "rank_team_faced")
    return team_stats.join(d, ["fixture_id", "team_id"]).where(F.col("total_shots_avg").isNotNull())


def gold_match_table(silver_fixture: DataFrame, team_stats: DataFrame, difficulty: DataFrame,
                     silver_coach: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per match: away/home ratios of team form, carried-over side
    features and the coach in charge of each side on the match date.

    Team-level rows join twice (role-playing: once as away, once as home);
    both joins read the same exchange.  Overlapping coach stints multiply
    rows as in the reference unless ``dedupe``.
    """
    tl = team_level(team_stats, difficulty)

    def side(prefix):
        return tl.select(F.col("fixture_id").alias(f"{prefix}fid"), F.col("team_id").alias(f"{prefix}tid"),
                         *[F.col(c).alias(prefix + c) for c in TEAM_LEVEL_COLS])

    a, h = side("a_"), side("h_")
    m = silver_fixture.join(a, (F.col("fixture_id") == F.col("a_fid")) & (F.col("away_team_id") == F.col("a_tid")))
    m = m.join(h, (F.col("fixture_id") == F.col("h_fid")) & (F.col("home_team_id") == F.col("h_tid")))
    m = coach_on_date(m, silver_coach, "away_team_id", out="coach_id_away")
    m = coach_on_date(m, silver_coach, "home_team_id", out="coach_id_home")
    m = m.where(ratio("a_total_shots_avg", "h_total_shots_avg").isNotNull())
    out = m.select(
        *silver_fixture.columns,
        F.col("a_rank_team_faced").alias("rank_team_faced_away"),
        F.col("h_rank_team_faced").alias("rank_team_faced_home"),
        ratio("a_total_shots_avg", "h_total_shots_avg").alias("total_shots_r"),
        ratio("a_prior_season_rank", "h_prior_season_rank").alias("prior_season_rank"),
        ratio("a_possession_avg", "h_possession_avg").alias("possession_r"),
        F.col("a_red_cards").alias("red_cards_away"),
        F.col("h_red_cards").alias("red_cards_home"),
        ratio("a_gk_saves_avg", "h_gk_saves_avg").alias("gk_saves_r"),
        ratio("a_fouls_avg", "h_fouls_avg").alias("fouls_r"),
        ratio("a_pass_accuracy_avg", "h_pass_accuracy_avg").alias("pass_accuracy_r"),
        "coach_id_away", "coach_id_home",
    )
    return out.dropDuplicates() if dedupe else out
