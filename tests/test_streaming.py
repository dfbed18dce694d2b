"""Once-per-file ingest: nothing is read twice, nothing is lost, the latest wins."""

import json

import pytest

from matchlake.sources import raw
from matchlake.streaming.ingest import ingest_new, ingested

FIXTURE = ("fixture_date string, fixture_id long, referee string, status string, venue_id long, away_goals long, "
           "home_goals long, league_id long, season long, away_team_id long, home_team_id long")


@pytest.fixture()
def folders(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "ck")


def land_fixtures(spark, src, rows):
    fx = spark.createDataFrame([(d, i, "R", s, 1, g, g, 1, 2022, 3, 4) for d, i, s, g in rows], FIXTURE)
    raw.land(raw.by_month(raw.fixture_payloads(fx)), src, ["month"], mode="append")


def fixtures(spark, out):
    return sorted((r.fixture_id, r.fixture_date, r.status, r.away_goals) for r in ingested(spark, out).collect())


def test_ingest_once_per_file(spark, folders):
    src, out, ck = folders
    land_fixtures(spark, src, [("2022-01-01", 1, "FT", 1), ("2022-02-03", 2, "FT", 2)])
    assert ingest_new(spark, src, "fixtures", out, ck) >= 1
    assert len(fixtures(spark, out)) == 2
    assert ingest_new(spark, src, "fixtures", out, ck) == 0          # nothing new
    land_fixtures(spark, src, [("2022-03-05", 3, "FT", 0)])
    ingest_new(spark, src, "fixtures", out, ck)
    assert [r[0] for r in fixtures(spark, out)] == [1, 2, 3]


def test_relanded_match_replaces_its_row(spark, folders):
    src, out, ck = folders
    land_fixtures(spark, src, [("2022-01-01", 1, "NS", None), ("2022-01-02", 2, "FT", 2)])
    ingest_new(spark, src, "fixtures", out, ck)
    land_fixtures(spark, src, [("2022-01-01", 1, "FT", 3)])
    ingest_new(spark, src, "fixtures", out, ck)
    assert fixtures(spark, out) == [(1, "2022-01-01", "FT", 3), (2, "2022-01-02", "FT", 2)]


def test_later_files_of_a_date_keep_the_earlier_rows(spark, folders):
    src, out, ck = folders
    for i in range(1, 5):
        land_fixtures(spark, src, [("2022-01-01", i, "FT", i)])
        if i == 2:
            ingest_new(spark, src, "fixtures", out, ck, max_files_per_trigger=1)
    assert ingest_new(spark, src, "fixtures", out, ck, max_files_per_trigger=1) == 2
    assert [r[0] for r in fixtures(spark, out)] == [1, 2, 3, 4]


def test_postponed_match_moves(spark, folders):
    src, out, ck = folders
    land_fixtures(spark, src, [("2022-01-01", 1, "NS", None)])
    ingest_new(spark, src, "fixtures", out, ck)
    land_fixtures(spark, src, [("2022-03-01", 1, "FT", 1), ("2022-03-02", 2, "FT", 1)])
    ingest_new(spark, src, "fixtures", out, ck)
    assert fixtures(spark, out) == [(1, "2022-03-01", "FT", 1), (2, "2022-03-02", "FT", 1)]
    land_fixtures(spark, src, [("2022-01-03", 9, "FT", 1)])
    ingest_new(spark, src, "fixtures", out, ck)
    assert [r[0] for r in fixtures(spark, out)] == [1, 2, 9]


def land_text(spark, src, docs):
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.mode("append").text(src)


def test_two_leagues_of_one_season(spark, folders):
    src, out, ck = folders
    for league in (1, 2):
        rows = [{"rank": k, "team": {"id": 10 * league + k}, "all": {"played": 1, "win": 1, "lose": 0, "draw": 0}} for k in (1, 2)]
        land_text(spark, src, [{"response": [{"league": {"id": league, "season": 2022, "standings": [rows]}}]}])
        ingest_new(spark, src, "standing", out, ck, max_files_per_trigger=1)
    assert sorted((r.league_id, r.team_id) for r in ingested(spark, out).collect()) == [(1, 11), (1, 12), (2, 21), (2, 22)]


def test_coach_with_two_teams(spark, folders):
    src, out, ck = folders
    land_text(spark, src, [{"response": [{"id": 1, "career": [{"team": {"id": 5}, "start": "2020-01-01", "end": None}]}]}])
    ingest_new(spark, src, "coach", out, ck)
    land_text(spark, src, [{"response": [{"id": 2, "career": [{"team": {"id": 7}, "start": "2021-01-01", "end": None}, {"team": {"id": 5}, "start": "2019-01-01", "end": "2019-12-31"},
                                                             {"team": {"id": None}, "start": None, "end": None}, {"team": {"id": None}, "start": None, "end": "2001-01-01"}]}]}])
    ingest_new(spark, src, "coach", out, ck)
    got = sorted(((r.coach_id, r.team_id, r.end_date) for r in ingested(spark, out).collect()), key=str)
    assert got == sorted([(1, 5, None), (2, 7, None), (2, 5, "2019-12-31"), (2, None, None), (2, None, "2001-01-01")], key=str)


def test_statistics_of_one_date_in_two_files(spark, folders):
    src, out, ck = folders
    for fixture in (1, 2):
        stats = [{"type": str(k), "value": str(fixture * 100 + k)} for k in range(16)]
        land_text(spark, src, [{"Date": "2022-01-01", "Data": {"parameters": {"fixture": str(fixture)}, "response": [{"team": {"id": t}, "statistics": stats} for t in (3, 4)]}}])
    assert ingest_new(spark, src, "fixture-stats", out, ck, max_files_per_trigger=1) == 2
    assert sorted((r.fixture_id, r.team_id, r.total_shots) for r in ingested(spark, out).collect()) == [(1, 3, "102"), (1, 4, "102"), (2, 3, "202"), (2, 4, "202")]
