"""Hand-written payload cases (bronze flattening and silver rules)."""

import json

from pyspark.sql import functions as F

from matchlake.operators import silver
from matchlake.sources import raw


def _write(tmp, kind, name, text):
    import os
    d = os.path.join(tmp, kind, name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name + ".json"), "w") as f:
        f.write(text)
    return os.path.join(tmp, kind)


def _stats(values):
    return [{"type": f"t{i}", "value": v} for i, v in enumerate(values)]


def test_fixture_stats_cases(spark, tmp_path):
    tmp = str(tmp_path)
    full = [None, None, 12, None, None, None, 7, None, None, "55%", None, None, 3, 400, 350]
    doc = [{"Date": "2023-01-01", "Data": {"parameters": {"fixture": "10"}, "response": [
        {"team": {"id": 1}, "statistics": _stats(full)},
        {"team": {"id": 2}, "statistics": _stats(full[:9])},       # short array
        {"team": {"id": 3}, "statistics": []},
    ]}}]
    _write(tmp, "fixture-stats", "2023-01-01", json.dumps(doc, indent=2))
    _write(tmp, "fixture-stats", "2023-01-02", "null")                       # empty day
    _write(tmp, "fixture-stats", "2023-01-03", '{"message": "quota"}')       # error body
    _write(tmp, "fixture-stats", "2023-01-04", '{"response":[')              # malformed
    r = raw.read_raw(spark, tmp + "/fixture-stats/*/*.json", "fixture-stats", multiline=True)
    b = raw.bronze_fixture_stat(r).orderBy("team_id").collect()
    assert [x.team_id for x in b] == [1, 2, 3]
    assert b[0].total_shots == "12" and b[0].possession == "55%" and b[0].red_cards is None
    assert b[0].a_passes == "350" and b[0].fouls == "7"
    assert b[1].total_shots == "12" and b[1].possession is None      # past the end -> NULL
    assert b[2].total_shots is None
    # silver: percent stripped, red cards default 0, NULL shots dropped
    standings = spark.createDataFrame([(1,), (2,), (3,)], "team_id long")
    s = silver.silver_fixture_stat(raw.bronze_fixture_stat(r), standings).orderBy("team_id").collect()
    assert [x.team_id for x in s] == [1, 2]
    assert s[0].possession == 55.0 and s[0].red_cards == 0.0 and s[0].total_shots == 12.0


def test_fixtures_and_labels(spark, tmp_path):
    tmp = str(tmp_path)

    def fx(i, away, home, league=1):
        return {"fixture": {"id": i, "referee": "R", "status": {"short": "FT"}, "venue": {"id": 5}},
                "goals": {"away": away, "home": home}, "league": {"id": league, "season": 2022},
                "teams": {"away": {"id": 100 + i}, "home": {"id": 200 + i}}}
    doc = {"parameters": {"date": "2022-08-01"},
           "response": [fx(1, 2, 1), fx(2, 0, 3), fx(3, 1, 1), fx(4, 1, None), fx(5, None, None), fx(6, 1, 0, 9)]}
    _write(tmp, "fixtures", "2022-08-01", json.dumps(doc, indent=2))
    _write(tmp, "fixtures", "2022-08-02", json.dumps({"parameters": {"date": "2022-08-02"}, "response": []}))
    r = raw.read_raw(spark, tmp + "/fixtures/*/*.json", "fixtures", multiline=True)
    b = raw.bronze_fixture(r)
    assert b.count() == 6
    st = spark.createDataFrame([(1, 2021, 1, 1, 1, 1, 0, 0)],
                               "league_id long, season long, rank long, team_id long, played long, won long, lost long, draw long")
    s = {x.fixture_id: x.match_result for x in silver.silver_fixture(b, st).collect()}
    # unknown league 9 dropped, unplayed (NULL away goals) dropped, NULL home goals -> Draw
    assert s == {1: "Away", 2: "Home", 3: "Draw", 4: "Draw"}


def test_standings_first_group_and_ids(spark, tmp_path):
    tmp = str(tmp_path)

    def row(rank, team):
        return {"rank": rank, "team": {"id": team}, "all": {"played": 3, "win": 1, "lose": 1, "draw": 1}}
    doc = {"response": [{"league": {"id": 7, "season": 2022, "standings": [[row(1, 11), row(2, 12)], [row(1, 13)]]}}]}
    _write(tmp, "standing", "7", json.dumps(doc, indent=2))
    r = raw.read_raw(spark, tmp + "/standing/*/*.json", "standing", multiline=True)
    assert sorted(x.team_id for x in raw.bronze_standings(r).collect()) == [11, 12]
    assert sorted(x.team_id for x in raw.standing_team_ids(r).collect()) == [11, 12, 13]
    assert sorted(x.team_id for x in raw.bronze_standings(r, group=1).collect()) == [13]


def test_coach_cases(spark, tmp_path):
    tmp = str(tmp_path)
    doc = {"response": [
        {"id": 1, "career": [{"team": {"id": 5}, "start": "2020-01-01", "end": None},
                             {"team": {"id": None}, "start": "2018-01-01", "end": "2019-01-01"}]},
        {"id": 2, "career": [{"team": {"id": 5}, "start": None, "end": "2021-01-01"}]},
        {"id": 3, "career": [{"team": {"id": 5}, "start": "2020-06-01", "end": "2020-06-30"}]},
    ]}
    _write(tmp, "coach", "5", json.dumps(doc, indent=2))
    r = raw.read_raw(spark, tmp + "/coach/*/*.json", "coach", multiline=True)
    c = silver.silver_coach(raw.bronze_coach(r))
    rows = {x.coach_id: x.calc_end_date for x in c.collect()}
    assert rows[1] == "2099-12-31" and len(c.collect()) == 3          # team NULL dropped
    from matchlake.operators.joins import coach_on_date
    fx = spark.createDataFrame([(1, 5, "2020-06-01"), (2, 5, "2020-06-30"), (3, 5, "2019-12-31")],
                               "fixture_id long, team_id long, fixture_date string")
    got = sorted((x.fixture_id, x.coach_id) for x in coach_on_date(fx, c, "team_id").collect())
    # boundaries inclusive, overlapping stints both match, NULL start never matches
    assert got == [(1, 1), (1, 3), (2, 1), (2, 3)]


def test_malformed_reported(spark, tmp_path):
    tmp = str(tmp_path)
    _write(tmp, "coach", "1", '{"response":[')
    _write(tmp, "coach", "2", '{"response":[{"id":9,"career":[{"team":{"id":1},"start":"2020-01-01"}]}]}')
    r = raw.read_raw(spark, tmp + "/coach/*/*.json", "coach", multiline=True).cache()
    assert raw.bad_records(r).count() == 1
    assert raw.bronze_coach(r).count() == 1
    text = '{"z":1.10,"extra":{"x":[2,{}],"é\\"{":"a, b"},"n":null,"e":[]}'
    good, bad = raw.valid_json(spark.createDataFrame([(text,), ('{"a":',), (None,)], "value string"))
    assert good.count() == 1 and bad.count() == 2
    assert good.first().value == json.dumps(json.loads(text), indent=2, ensure_ascii=False).replace("1.1,", "1.10,")


def test_json_lines_landing_roundtrip(spark, tmp_path):
    fx = spark.createDataFrame([("2022-01-01", 1, "R", "FT", 1, 1, 0, 1, 2022, 3, 4),
                                ("2022-01-02", 2, "R", "NS", 1, None, None, 1, 2022, 3, 4)],
                               "fixture_date string, fixture_id long, referee string, status string, venue_id long, "
                               "away_goals long, home_goals long, league_id long, season long, away_team_id long, "
                               "home_team_id long")
    path = str(tmp_path / "raw" / "fixtures")
    raw.land(raw.by_month(raw.fixture_payloads(fx)), path, ["month"])
    back = raw.bronze_fixture(raw.read_raw(spark, path, "fixtures"))
    assert sorted(back.collect()) == sorted(fx.collect())
    assert sorted(x.fixture_id for x in raw.payload_ids(raw.read_raw(spark, path, "fixtures")).collect()) == [1, 2]


def test_payload_texts_are_indented_once_for_filter_and_result(spark):
    df = spark.createDataFrame([('{"a":[1,{}]}',), ('{"a":1}]',), (None,)], "value string")
    good, bad = raw.valid_json(df)
    assert good._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
    assert [r.value for r in good.collect()] == ['{\n  "a": [\n    1,\n    {}\n  ]\n}']
    assert sorted(r.value or "" for r in bad.collect()) == ["", '{"a":1}]']
