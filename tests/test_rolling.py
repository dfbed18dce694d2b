"""Chunked (halo) rolling means equal one-window-per-key and a brute force."""

import random

import pytest
from pyspark.sql import functions as F

from matchlake.operators.rolling import rolling_mean


def _data(seed=7, n=1500):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 6)      # one hot key (~40 % of rows)
        day = rnd.randint(0, 120)                                    # many same-day ties
        v = None if rnd.random() < 0.1 else float(rnd.randint(0, 50))
        rows.append((key, f"2020-{1 + day // 28:02d}-{1 + day % 28:02d}", i, v))
    return rows


def _brute(rows, n, direction):
    out = {}
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for key, rs in by_key.items():
        rs.sort(key=lambda r: (r[1], r[2]), reverse=(direction == "desc"))
        for p, r in enumerate(rs):
            frame = [x[3] for x in rs[max(0, p - n):p] if x[3] is not None]
            out[r[2]] = sum(frame) / len(frame) if frame else None
    return out


@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_chunked_equals_brute_force(spark, direction):
    rows = _data()
    df = spark.createDataFrame(rows, "k long, d string, id long, v double")
    specs = [("m9", F.col("v"), 9), ("m4", F.col("v"), 4)]
    plain = rolling_mean(df, ["k"], ["d", "id"], specs, direction=direction)
    chunked = rolling_mean(df, ["k"], ["d", "id"], specs, direction=direction, chunk=F.col("d"))
    coarse = rolling_mean(df, ["k"], ["d", "id"], specs, direction=direction, chunk=F.substring("d", 1, 7))
    exp9, exp4 = _brute(rows, 9, direction), _brute(rows, 4, direction)
    for res in (plain, chunked, coarse):
        got = {r.id: (r.m9, r.m4) for r in res.collect()}
        assert len(got) == len(rows)
        for i, (m9, m4) in got.items():
            for a, b in ((m9, exp9[i]), (m4, exp4[i])):
                assert (a is None and b is None) or abs(a - b) < 1e-9


def test_latest_match_has_empty_frame(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 1, 1.0), (1, "2020-01-02", 2, 3.0)],
                               "k long, d string, id long, v double")
    got = {r.id: r.m for r in rolling_mean(df, ["k"], ["d", "id"], [("m", F.col("v"), 9)],
                                           chunk=F.col("d")).collect()}
    assert got == {2: None, 1: 3.0}     # DESC frame looks at later matches


def test_chunked_plan_partitions_by_key_and_chunk(spark):
    df = spark.createDataFrame(_data(n=200), "k long, d string, id long, v double")
    res = rolling_mean(df, ["k"], ["d", "id"], [("m", F.col("v"), 9)], chunk=F.col("d"))
    plan = res._jdf.queryExecution().executedPlan().toString()
    # the only full-data exchange hashes on (key, chunk); no window runs on a bare key partitioning
    assert "hashpartitioning(k#" in plan and "__chunk" in plan
    lines = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(k#" in ln]
    assert lines and all("__chunk" in ln or "__targets" in ln or "ENSURE_REQUIREMENTS" in ln for ln in lines)


def test_tail_rows_are_limited_before_their_exchange(spark):
    df = spark.createDataFrame(_data(n=200), "k long, d string, id long, v double")
    res = rolling_mean(df, ["k"], ["d", "id"], [("m", F.col("v"), 9)], chunk=F.substring("d", 1, 7))
    text = res._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    full = [ln for ln in text.splitlines() if "REPARTITION_BY_COL" in ln or "RepartitionByExpression" in ln]
    assert len(full) == 2          # all rows once, and the halo rows


def test_a_chunk_gets_at_most_n_halo_rows(spark):
    df = spark.createDataFrame(_data(), "k long, d string, id long, v double")
    res = rolling_mean(df, ["k"], ["d", "id"], [("m9", F.col("v"), 9), ("m4", F.col("v"), 4)], chunk=F.col("d"), keep=["k", "id"])
    plan = res._jdf.queryExecution().analyzed()
    while "Union" not in plan.nodeName():
        plan = plan.children().apply(0)
    halo = [c for c in (plan.children().apply(i) for i in range(2)) if "__targets" in c.toString()]
    assert len(halo) == 1
    rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, halo[0])
    from pyspark.sql import DataFrame
    sizes = DataFrame(rows, spark).groupBy("k", "__chunk").count().collect()
    assert sizes and max(r["count"] for r in sizes) == 9


def test_small_side_broadcasts_only_under_bound(spark):
    from matchlake.operators.joins import small_side
    small = spark.range(10)
    big = spark.range(1000)
    a = spark.range(5).join(small_side(small, 100), "id")
    b = spark.range(5).join(small_side(big, 100), "id")
    assert "ResolvedHint (strategy=broadcast)" in a._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in a._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in b._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_balanced_chunks_spread_a_hot_day(spark, direction):
    rnd = random.Random(3)
    rows = [(0, "2020-01-15" if rnd.random() < 0.7 else f"2020-01-{rnd.randint(1, 28):02d}", i, float(rnd.randint(0, 9))) for i in range(4000)]
    rows += [(k, f"2020-02-{d:02d}", 4000 + 30 * k + d, None if d % 5 else 1.0) for k in range(1, 4) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "k long, d string, id long, v double")
    from matchlake.operators.rolling import balanced
    pieces, chunk = balanced(df, ["k"], ["d", "id"], 100)
    sizes = pieces.groupBy("k", chunk.alias("c")).count().collect()
    hot = [r["count"] for r in sizes if r["k"] == 0]
    assert max(hot) <= 400 and len(hot) >= 20 and sum(hot) == 4000
    assert [r["count"] for r in sizes if r["k"] == 2] == [28]
    got = rolling_mean(df, ["k"], ["d", "id"], [("m9", F.col("v"), 9)], direction=direction, chunk="balanced", chunk_rows=100)
    want = _brute(rows, 9, direction)
    found = {r.id: r.m9 for r in got.collect()}
    assert found.keys() == want.keys()
    assert all((found[i] is None and want[i] is None) or abs(found[i] - want[i]) < 1e-9 for i in want)
    assert balanced(df, ["k"], ["d", "id"], 4000) is None
