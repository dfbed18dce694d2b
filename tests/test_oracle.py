"""Registered queries against their DuckDB twins on sf0.001 (the driver runs
the same comparison at sf0.01)."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from matchlake.sources.binding import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
FAST = ["bronze_fixture", "bronze_standings", "bronze_fixture_stat", "bronze_coach", "silver_fixture",
        "silver_fixture_stat", "silver_coach", "gold_team_stats", "gold_avg_team_difficulty",
        "gold_match_table", "gold_team_stats_asc", "gold_team_stats_single_window", "union_distinct",
        "team_rows_unpivot", "coach_on_date", "prior_season_join", "date_spine", "request_plan",
        "upsample_counts", "confusion", "knn", "payload_roundtrip_standings", "payload_roundtrip_coach"]


def _isnull(v):
    try:
        r = pd.isna(v)
    except (TypeError, ValueError):
        return False
    return bool(r) if isinstance(r, (bool, np.bool_)) else False


def _norm(v):
    if _isnull(v):
        return ""
    if isinstance(v, (float, np.floating)) or isinstance(v, (int, np.integer)) and not isinstance(v, bool):
        return f"{float(v):.9g}"
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted(tuple(_norm(x) for x in rec) for rec in pdf[cols].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_a_callable():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    s_pd = sdf.toPandas()
    d_pd = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(s_pd.columns) == sorted(d_pd.columns)
    assert len(s_pd) == len(d_pd)
    assert _rows(s_pd) == _rows(d_pd)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "coach_id_home" in df.columns
