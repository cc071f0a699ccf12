"""Property tests (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantlake.functions import health_score, safe_ratio
from plantlake.operators import quality
from plantlake.plans.joins import interval_join

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
signal = st.one_of(st.none(), st.floats(min_value=-50, max_value=500, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(signal, signal, signal), min_size=1, max_size=20), st.floats(min_value=0, max_value=5))
def test_score_in_range_and_monotone(spark, rows, bump):
    df = spark.createDataFrame(rows, "v double, t double, a double")
    s0 = health_score(F.col("v"), F.col("t"), F.col("a"))
    s1 = health_score(F.col("v") + bump, F.col("t") + bump, F.col("a") + bump)
    for r in df.select(s0.alias("s0"), s1.alias("s1")).collect():
        assert 0.0 <= r.s0 <= 100.0
        assert r.s1 <= r.s0 + 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=20))
def test_availability_in_unit_interval(spark, rows):
    df = spark.createDataFrame(rows, "run bigint, down bigint")
    for r in df.select(safe_ratio(F.col("run"), F.col("run") + F.col("down")).alias("a")).collect():
        assert r.a is None or 0.0 <= r.a <= 1.0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t", None]), st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True)),
                          st.sampled_from(["Good", "Bad", "Uncertain", "Weird", None])), min_size=1, max_size=30))
def test_good_plus_quarantine_is_input(spark, rows):
    data = [(tag, "A", dt.datetime(2024, 1, 1), v, q, "u", "mock_pi", "P", "AR") for tag, v, q in rows]
    df = spark.createDataFrame(data, "tag_name string, asset_id string, event_ts timestamp, value double, quality string, "
                                     "uom string, source_system string, plant_id string, area_id string")
    good, bad = quality.check_contract(df)
    assert good.count() + bad.count() == len(rows)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 72 * 60), st.one_of(st.none(), st.integers(-120, 40 * 60))),
                min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 3), st.integers(0, 72 * 60), st.integers(0, 6 * 60)), min_size=1, max_size=8))
def test_bucketed_interval_join_equals_plain(spark, events, windows):
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame(
        [(i, f"k{k}", t0 + dt.timedelta(minutes=s), None if d is None else t0 + dt.timedelta(minutes=s + d))
         for i, (k, s, d) in enumerate(events)], "eid int, key string, s timestamp, e timestamp")
    win = spark.createDataFrame(
        [(j, f"k{k}", t0 + dt.timedelta(minutes=s), t0 + dt.timedelta(minutes=s + d)) for j, (k, s, d) in enumerate(windows)],
        "wid int, key string, ws timestamp, we timestamp")
    for unit in ("MINUTE", "HOUR", "DAY"):
        b = interval_join(win, ev, ["key"], "ws", "we", "s", "e", bucketed=True, unit=unit)
        p = interval_join(win, ev, ["key"], "ws", "we", "s", "e", bucketed=False)
        assert sorted(map(tuple, b.select("wid", "eid").collect())) == sorted(map(tuple, p.select("wid", "eid").collect()))
    bp = interval_join(win, ev.drop("e"), ["key"], "ws", "we", "s", bucketed=True)
    pp = interval_join(win, ev.drop("e"), ["key"], "ws", "we", "s", bucketed=False)
    assert sorted(map(tuple, bp.select("wid", "eid").collect())) == sorted(map(tuple, pp.select("wid", "eid").collect()))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-3000, 5000), st.integers(-3, 5000)), min_size=1, max_size=20))
def test_block_cover_partitions_the_range(spark, ranges):
    from plantlake.plans.joins import cover_levels_sql, cover_nodes_sql
    k = 13  # every index drawn here lies in [-2^13, 2^13)
    left, right = cover_nodes_sql(k)
    df = spark.createDataFrame([(i, a, a + d) for i, (a, d) in enumerate(ranges)], "i int, _a bigint, _b bigint")
    rows = df.withColumn("_l", F.explode_outer(F.expr(cover_levels_sql(k)))).select(
        "i", "_l", F.expr(left).alias("x"), F.expr(right).alias("y")).collect()
    for i, (a, d) in enumerate(ranges):
        blocks = [(r._l, n) for r in rows if r.i == i for n in (r.x, r.y) if n is not None]
        if d < 0:
            assert blocks == []
            continue
        covered = sorted(b for lvl, n in blocks for b in range(n << lvl, (n + 1) << lvl))
        assert covered == list(range(a, a + d + 1))  # disjoint and complete
        assert len(blocks) <= 2 * max(1, (d + 1).bit_length()) + 2


def test_hot_key_candidates_stay_near_the_output(spark):
    # one key holds every window and event, a third of them still open: the
    # stabbing join's candidate pairs (before the residual filter) must stay
    # close to the true pairs, where a per-key "long" bucket would pair all
    from plantlake.plans.joins import stab_sides
    t0 = dt.datetime(2024, 1, 1)
    win = spark.createDataFrame([(j, "hot", t0 + dt.timedelta(minutes=97 * j), t0 + dt.timedelta(minutes=97 * j + 30))
                                 for j in range(300)], "wid int, key string, ws timestamp, we timestamp")
    ev = spark.createDataFrame(
        [(i, "hot", t0 + dt.timedelta(minutes=131 * i),
          None if i % 3 == 0 else t0 + dt.timedelta(minutes=131 * i + 45 + 600 * (i % 5))) for i in range(300)],
        "eid int, key string, s timestamp, e timestamp")
    out = interval_join(win, ev, ["key"], "ws", "we", "s", "e").count()
    assert out == interval_join(win, ev, ["key"], "ws", "we", "s", "e", bucketed=False).count()
    wb, eb = stab_sides(win, ev, "ws", "we", "s", "e")
    candidates = wb.join(eb, ["key", "_lvl", "_node"]).count()
    assert out > 10_000 and candidates <= 1.2 * out
