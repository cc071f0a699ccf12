"""Plan tests: pushdown, pruning, broadcast choice, no Python evaluation in any registered query."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from plantlake.operators import gold, serving, silver
from plantlake.plans import registry as E


# These queries write files while they are built, as sinks do.
WRITERS = ("table_changes", "changes_applied", "csv_", "points_landing", "table_sink", "table_compact", "bronze_tables", "batch_tables", "table_replace", "live_views", "poll_replay", "stream_")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_query(spark):
    for name, fn in E.queries().items():
        if name.startswith(WRITERS):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_health_plan_one_broadcast_join_and_pruned_scan(spark):
    df = E.queries()["health_daily"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_points_recent_pushes_filters_and_prunes_partitions(spark, tmp_path):
    from plantlake.schemas import POINTS_RAW_SCHEMA
    t0 = dt.datetime(2024, 1, 1)
    rows = [("\\\\P\\A|Vibration", "A", t0 + dt.timedelta(days=d), 1.0, "Good", "u", "mock_pi", "PLANT-01", "AR", t0, None)
            for d in range(30)]
    pts = silver.silver_points(spark.createDataFrame(rows, POINTS_RAW_SCHEMA)).withColumn("event_date", F.to_date("event_ts"))
    path = str(tmp_path / "pts")
    pts.write.partitionBy("event_date").parquet(path)
    recent = serving.points_recent(spark.read.parquet(path), 7, "2024-01-31 00:00:00")
    p = plan(recent)
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in p
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert recent.count() == 7


def test_quality_filter_pushed_to_scan(spark, tmp_path):
    from plantlake.sources import shims
    path = str(tmp_path / "raw")
    shims.points_raw(spark, SF_SMALL).write.parquet(path)
    p = plan(silver.silver_points(spark.read.parquet(path)))
    assert "In(quality, [Good,Uncertain])" in p


def test_whole_stage_codegen_present(spark):
    df = E.queries()["tag_hourly"](spark, SF_SMALL)
    df.collect()  # the adaptive plan of this frame is final after it ran
    p = plan(df)
    assert "isFinalPlan=true" in p and "*(" in p


def test_per_asset_top_k_is_limited_before_the_shuffle(spark):
    # row_number() <= n per asset: each map task forwards at most n rows per asset
    for name in ("recent_failures", "advisor_evidence"):
        p = plan(E.queries()[name](spark, SF_SMALL))
        lines = p.splitlines()
        partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
        assert partial, name
        # the partial limit sits below (is fed into) a hash exchange on the asset keys
        assert any("Exchange hashpartitioning(plant_id" in ln for ln in lines[:partial[0]]), name


def test_lists_do_not_grow_with_a_group(spark):
    # per-asset orders and per-window alarms are long form: no collect over them
    for name in ("advisor_evidence", "rca_alarms", "shift_brief"):
        p = plan(E.queries()[name](spark, SF_SMALL))
        # (the set of window size classes, at most one per power of two, is not a list of rows)
        assert "collect_list" not in p and "collect_set" not in p.replace("collect_set(_c", ""), name


def test_advisor_orders_meet_their_asset_in_a_join_that_can_be_split(spark):
    p = plan(E.queries()["advisor_evidence"](spark, SF_SMALL))
    joins = [ln for ln in p.splitlines() if "Join" in ln and "Inner" in ln]
    assert joins  # AQE splits either side of an inner join


def test_no_job_runs_while_a_query_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, fn in E.queries().items():
        if name.startswith(WRITERS):
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        try:
            fn(spark, SF_SMALL)
            jobs = [j for j in tracker.getJobIdsForGroup(f"build-{name}")]
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # reading a footer for its schema is a job of one task; nothing else may run
        assert all(len(tracker.getJobInfo(j).stageIds) == 1 and
                   tracker.getStageInfo(tracker.getJobInfo(j).stageIds[0]).numTasks == 1 for j in jobs
                   if tracker.getJobInfo(j)), name


def test_no_cross_or_nested_loop_join_in_any_query(spark):
    # every join is an equi-join on keys (range joins go through the stabbing join)
    for name, fn in E.queries().items():
        if name.startswith(WRITERS):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_rows_cut_from_texts_are_no_broadcast_side(spark):
    # the files' size tells nothing of the rows that come of cutting the texts; only the dictionary may be broadcast
    p = plan(E.queries()["serving_shifts_dictionary"](spark, SF_SMALL))
    joins = [ln for ln in p.splitlines() if "Join" in ln]
    assert any("LeftSemi" in ln for ln in joins) and any("SortMergeJoin" in ln and "LeftOuter" in ln for ln in joins)
    assert not [ln for ln in joins if "BuildLeft" in ln or "Inner" in ln or "BroadcastHashJoin" in ln and "LeftOuter" in ln]


def test_no_version_of_a_table_is_broadcast(spark, tmp_path):
    # small files of wide rows, all of which change: only digests may be a broadcast side
    from plantlake.plans.changes import apply_changes, table_changes
    for name, text in (("old", "x"), ("new", "y")):
        spark.range(300).select("id", F.repeat(F.lit(text), 2000).alias("text")).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    changes = table_changes(old, new, ["id"])
    joins = [ln for ln in plan(changes).splitlines() if "Join" in ln]
    assert joins and all("LeftSemi" in ln for ln in joins)
    assert {r["_change_type"]: r["count"] for r in changes.groupBy("_change_type").count().collect()} == {
        "update_before": 300, "update_after": 300}
    assert apply_changes(old, changes).exceptAll(new).count() == 0


def test_no_step_of_applied_changes_is_broadcast(spark):
    # neither the orders' last lines nor changed digests go through the driver, small as their files are
    from plantlake.sources import shims
    for df in (shims.work_orders_raw(spark, SF_SMALL), E.queries()["changes_applied"](spark, SF_SMALL)):
        assert "Join" in plan(df) and "Broadcast" not in plan(df)


def test_merged_intervals_hold_one_sort_and_no_map_of_islands(spark):
    p = plan(E.queries()["downtime_islands"](spark, SF_SMALL))
    assert "HashAggregate" not in p and "ObjectHashAggregate" not in p and "SortAggregate" not in p
    assert p.count("Sort [") == 3  # a key's days, for what touches midnight and for what does not, and the stitching
