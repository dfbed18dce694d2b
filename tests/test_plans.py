"""Plans that must hold at scale: checked broadcasts, needed layers only."""

import pytest
from pyspark.sql import functions as F

from matchlake import catalog
from matchlake.functions.ranking import global_index
from matchlake.operators import joins, silver

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["silver_fixture", "silver_fixture_stat"])
def test_facts_are_not_shuffled_on_few_valued_keys(spark, no_automatic_broadcast, name):
    text = plan(catalog.silver_all(spark, SF, name)[name])
    assert "BroadcastHashJoin" in text and "SortMergeJoin [league_id" not in text and "SortMergeJoin [team_id" not in text
    lines = text.splitlines()
    for at, line in enumerate(lines):  # the only exchanges on such a key are of the distinct ids, combined map-side
        if "hashpartitioning(league_id" in line or "hashpartitioning(team_id" in line:
            assert "HashAggregate(keys=[league_id" in lines[at + 1] or "HashAggregate(keys=[team_id" in lines[at + 1]


def test_dimension_joins_broadcast_after_a_size_check(spark, no_automatic_broadcast):
    s = catalog.silver_tables_materialized(spark, SF, silver.SILVER)
    on_date = joins.coach_on_date(s["silver_fixture"], s["silver_coach"], "home_team_id")
    prior = joins.prior_season_join(s["silver_fixture"], joins.prior_standing(s["silver_standing"]), "home_team_id")
    for df in (on_date, prior):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "hashpartitioning(home_team_id" not in text
    big = joins.small_side(s["silver_fixture"], max_rows=10)
    assert "SortMergeJoin" in plan(spark.range(5).withColumnRenamed("id", "fixture_id").join(big, "fixture_id"))


def test_difficulty_needs_no_statistics(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("not needed")
    monkeypatch.setattr(silver, "silver_fixture_stat", fail)
    monkeypatch.setattr(silver, "silver_coach", fail)
    assert catalog.gold_all(spark, SF, needed=("gold_avg_team_difficulty",))[1]["gold_avg_team_difficulty"].count() > 0


def test_global_index_numbers_rows_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 10).alias("a"), "id")
    got = global_index(df, [F.desc("a"), F.asc("id")], "n").collect()
    want = sorted(((i * 7 % 10, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r.n)] == want and sorted(r.n for r in got) == list(range(1000))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from matchlake.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", getConf=lambda: SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))
