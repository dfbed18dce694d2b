"""DuckDB SQL twins of the registered queries (the correctness oracle).

The projection of the driver tables (``sources.binding``) and the
bronze -> silver -> gold models are written once as named CTE blocks; a query
text is the dependency closure of the blocks it names plus its final SELECT.
Only portable SQL is used: ``nullif`` for NULL-on-zero division,
``regexp_replace(..., 'g')`` for replace-all, explicit casts where DuckDB and
Spark pick different integer widths.
"""

from __future__ import annotations

CTE: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTE[name] = (deps, sql.strip())


_cte("bronze_fixture", [], """
SELECT cast(cast(o_orderdate AS date) AS varchar) AS fixture_date,
       o_orderkey AS fixture_id,
       o_orderpriority AS referee,
       CASE WHEN o_orderstatus = 'P' THEN 'NS' ELSE 'FT' END AS status,
       o_custkey % 7 AS venue_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE cast(floor(o_totalprice / 7) AS bigint) % 4 END AS away_goals,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE cast(floor(o_totalprice / 11) AS bigint) % 5 END AS home_goals,
       o_custkey % 4 AS league_id,
       cast(year(o_orderdate) AS bigint) AS season,
       (o_custkey % 40 + 4 * (1 + o_orderkey % 9)) % 40 AS away_team_id,
       o_custkey % 40 AS home_team_id
FROM orders""")

_cte("team_games", ["bronze_fixture"], """
SELECT league_id, season, home_team_id AS team_id,
       CASE WHEN home_goals > away_goals THEN 1 ELSE 0 END AS won,
       CASE WHEN home_goals < away_goals THEN 1 ELSE 0 END AS lost,
       CASE WHEN home_goals = away_goals THEN 1 ELSE 0 END AS draw
FROM bronze_fixture WHERE away_goals IS NOT NULL AND home_goals IS NOT NULL
UNION ALL
SELECT league_id, season, away_team_id AS team_id,
       CASE WHEN away_goals > home_goals THEN 1 ELSE 0 END,
       CASE WHEN away_goals < home_goals THEN 1 ELSE 0 END,
       CASE WHEN away_goals = home_goals THEN 1 ELSE 0 END
FROM bronze_fixture WHERE away_goals IS NOT NULL AND home_goals IS NOT NULL""")

_cte("team_table", ["team_games"], """
SELECT league_id, season, team_id, cast(count(*) AS bigint) AS played,
       cast(sum(won) AS bigint) AS won, cast(sum(lost) AS bigint) AS lost, cast(sum(draw) AS bigint) AS draw
FROM team_games GROUP BY league_id, season, team_id""")

_cte("bronze_standings", ["team_table"], """
SELECT league_id, season,
       cast(row_number() OVER (PARTITION BY league_id, season ORDER BY 3 * won + draw DESC, team_id) AS bigint) AS rank,
       team_id, played, won, lost, draw
FROM team_table""")

_cte("line_side", [], """
SELECT l_orderkey AS fixture_id, (l_linenumber % 2 = 0) AS is_home,
       sum(l_quantity) AS q_sum, min(l_quantity) AS q_min,
       sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS reds,
       count(*) AS n, max(l_linenumber) AS max_line
FROM lineitem GROUP BY l_orderkey, (l_linenumber % 2 = 0)""")

_cte("bronze_fixture_stat", ["line_side", "bronze_fixture"], """
SELECT s.fixture_id,
       CASE WHEN s.is_home THEN f.home_team_id ELSE f.away_team_id END AS team_id,
       cast(cast(s.q_sum AS bigint) AS varchar) AS total_shots,
       concat(cast(cast(s.q_sum AS bigint) % 101 AS varchar), '%') AS possession,
       cast(nullif(s.reds, 0) AS varchar) AS red_cards,
       cast(s.n AS varchar) AS gk_saves,
       cast(s.max_line AS varchar) AS fouls,
       cast(cast(s.q_sum AS bigint) AS varchar) AS tot_passes,
       cast(cast(s.q_min AS bigint) AS varchar) AS a_passes
FROM line_side s JOIN bronze_fixture f ON s.fixture_id = f.fixture_id""")

_cte("bronze_coach", [], """
SELECT min(c_custkey) AS coach_id, team_id, start_date, end_date FROM (
  SELECT c_custkey, c_custkey % 40 AS team_id,
         CASE c_nationkey % 3 WHEN 0 THEN '1994-01-01' WHEN 1 THEN '1996-06-01' ELSE '1999-01-01' END AS start_date,
         CASE c_nationkey % 3 WHEN 0 THEN '1996-06-30' WHEN 1 THEN '1998-12-31' ELSE NULL END AS end_date
  FROM customer) c
GROUP BY team_id, start_date, end_date""")

# --- silver -----------------------------------------------------------------

_cte("silver_fixture", ["bronze_fixture", "bronze_standings"], """
SELECT f.*, CASE sign(away_goals - home_goals) WHEN 1 THEN 'Away' WHEN -1 THEN 'Home' ELSE 'Draw' END AS match_result
FROM bronze_fixture f SEMI JOIN bronze_standings k ON k.league_id = f.league_id
WHERE away_goals IS NOT NULL""")

_cte("silver_standing", ["bronze_standings"], "SELECT * FROM bronze_standings")

#: statistic -> the text that is read as a number
STAT_TEXT = {c: c for c in ("total_shots", "possession", "red_cards", "gk_saves", "fouls", "tot_passes", "a_passes")}
STAT_TEXT["possession"] = "replace(possession, '%', '')"
_NUMBERS = {c: f"try_cast({text} AS double)" for c, text in STAT_TEXT.items()}
_NUMBERS["red_cards"] = f"coalesce({_NUMBERS['red_cards']}, 0)"

_cte("silver_fixture_stat", ["bronze_fixture_stat", "bronze_standings"], f"""
SELECT fixture_id, team_id, {', '.join(f'{number} AS {c}' for c, number in _NUMBERS.items())}
FROM bronze_fixture_stat s SEMI JOIN bronze_standings k ON k.team_id = s.team_id
WHERE total_shots IS NOT NULL""")

_cte("silver_coach", ["bronze_coach"], """
SELECT *, CASE WHEN end_date IS NULL THEN '2099-12-31' ELSE end_date END AS calc_end_date
FROM bronze_coach WHERE team_id IS NOT NULL""")

# --- gold: everything hangs on one row for each team of a match ---------------

_cte("team_matches", ["silver_fixture"], """
SELECT f.fixture_id, f.fixture_date, f.season, x.side, x.team_id, x.opponent_id
FROM silver_fixture f, LATERAL (VALUES ('home', f.home_team_id, f.away_team_id),
                                       ('away', f.away_team_id, f.home_team_id)) x(side, team_id, opponent_id)""")

_cte("prior_standing", ["silver_standing"], """
SELECT season, team_id, rank AS prior_season_rank FROM silver_standing GROUP BY ALL""")


def _recent(direction: str) -> str:
    """Named windows over a team's rows: the nine and the four before the current one
    in the given direction of time."""
    def window(n: int) -> str:
        keys = ", ".join(f"{c} {direction}" for c in ("fixture_date", "fixture_id", "prior_season_rank"))
        return f"(PARTITION BY team_id ORDER BY {keys} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"WINDOW nine AS {window(9)}, four AS {window(4)}"


_cte("form", ["silver_fixture_stat", "team_matches", "prior_standing"], """
SELECT s.*, s.a_passes / nullif(s.tot_passes, 0) AS pass_accuracy, m.fixture_date, p.prior_season_rank
FROM silver_fixture_stat s
JOIN (SELECT fixture_id, fixture_date, season FROM team_matches GROUP BY ALL) m ON m.fixture_id = s.fixture_id
JOIN prior_standing p ON p.team_id = s.team_id AND p.season + 1 = m.season""")

#: output -> (statistic, window)
FORM = {"total_shots_avg": ("total_shots", "nine"), "possession_avg": ("possession", "nine"), "red_cards": ("red_cards", "four"),
        "gk_saves_avg": ("gk_saves", "nine"), "fouls_avg": ("fouls", "nine"), "pass_accuracy_avg": ("pass_accuracy", "nine")}
for _name, _direction in (("gold_team_stats", "DESC"), ("gold_team_stats_asc", "ASC")):
    _cte(_name, ["form"], f"""
SELECT team_id, fixture_id, prior_season_rank, {', '.join(f'avg({c}) OVER {w} AS {out}' for out, (c, w) in FORM.items())}
FROM form {_recent(_direction)}""")

_cte("team_opponent_rows", ["team_matches", "prior_standing"], """
SELECT m.fixture_id, m.team_id, m.fixture_date, m.season, p.prior_season_rank
FROM team_matches m JOIN prior_standing p ON p.team_id = m.opponent_id AND p.season + 1 = m.season
GROUP BY ALL""")

_cte("gold_avg_team_difficulty", ["team_opponent_rows"], f"""
SELECT fixture_id, team_id, avg(prior_season_rank) OVER nine AS rank_team_faced
FROM team_opponent_rows {_recent('DESC')}""")

_cte("side", ["team_matches", "gold_team_stats", "gold_avg_team_difficulty", "silver_coach"], """
SELECT m.side, t.*, d.rank_team_faced, c.coach_id
FROM team_matches m
JOIN gold_team_stats t ON t.fixture_id = m.fixture_id AND t.team_id = m.team_id
JOIN gold_avg_team_difficulty d ON d.fixture_id = m.fixture_id AND d.team_id = m.team_id
JOIN silver_coach c ON c.team_id = m.team_id AND c.start_date <= m.fixture_date AND m.fixture_date <= c.calc_end_date
WHERE t.total_shots_avg IS NOT NULL""")

#: column of both sides -> its ratio (away by home) in the match table
RATIOS = {"total_shots_avg": "total_shots_r", "prior_season_rank": "prior_season_rank", "possession_avg": "possession_r",
          "gk_saves_avg": "gk_saves_r", "fouls_avg": "fouls_r", "pass_accuracy_avg": "pass_accuracy_r"}
#: columns that both sides keep
KEPT = {"rank_team_faced": "rank_team_faced", "red_cards": "red_cards", "coach_id": "coach_id"}

_cte("gold_match_table", ["silver_fixture", "side"], f"""
SELECT f.*, {', '.join(f'a.{c} / nullif(h.{c}, 0) AS {out}' for c, out in RATIOS.items())},
       {', '.join(f'a.{c} AS {out}_away, h.{c} AS {out}_home' for c, out in KEPT.items())}
FROM silver_fixture f
JOIN side a ON a.side = 'away' AND a.fixture_id = f.fixture_id
JOIN side h ON h.side = 'home' AND h.fixture_id = f.fixture_id
WHERE h.total_shots_avg <> 0""")


def closure(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTE[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(names: list[str], final: str) -> str:
    """``WITH <closure of names> <final>``."""
    order = closure(names)
    body = ",\n".join(f"{n} AS (\n{CTE[n][1]}\n)" for n in order)
    final = final.strip()
    if final[:5].upper() == "WITH ":  # merge the final query's own CTEs
        return f"WITH {body},\n{final[5:]}"
    return f"WITH {body}\n{final}"


def table_sql(name: str) -> str:
    return with_ctes([name], f"SELECT * FROM {name}")
