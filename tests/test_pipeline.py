"""Batch pipeline, sinks, compaction, catalogue, SQL functions and GLD options."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from plantlake.operators import gold, silver
from plantlake.plans.pipeline import run_batch, run_retention
from plantlake.plans.tables import catalogue, compact, write_table
from plantlake.plans.versions import read_current, versions
from plantlake.sources import shims


def test_run_batch_writes_every_layer(spark, tmp_path):
    raw = {name: fn(spark, SF_SMALL) for name, fn in shims.RAW_SHIMS.items()}
    root = str(tmp_path / "lake")
    rep = run_batch(spark, raw, root, as_of=dt.datetime(2024, 1, 31))
    for t in ("bronze.pi_timeseries_raw", "silver.pi_timeseries", "silver.work_orders", "gold.asset_tag_hourly",
              "gold.asset_health_daily", "gold.oee_daily", "ops_pii_restricted.shift_people"):
        assert rep.rows[t] > 0, t
    assert rep.rows["bronze.pi_timeseries_raw"] == raw["points_raw"].count()
    assert rep.quarantined["work_orders_raw"] > 0  # the planted 'n/a' labour hours
    assert os.path.isdir(os.path.join(root, "silver", "pi_timeseries"))
    hourly = os.path.join(root, "gold", "asset_tag_hourly")
    assert any(d.startswith("event_date=") for d in os.listdir(os.path.join(hourly, versions(spark, hourly)[-1][1])))
    # metric and serving objects are written, so every session sees them
    assert read_current(spark, f"{root}/serving_safe/asset_health_daily").count() == rep.rows["gold.asset_health_daily"]
    assert set(raw) == set(shims.RAW_SHIMS) and "event_date" not in raw["points_raw"].columns  # the argument is unchanged
    notes = read_current(spark, f"{root}/serving_safe/shifts")
    assert notes.filter("handoff_notes_redacted rlike '(?i)silva|van dam|núñez'").count() == 0
    masked = spark.table("shift_people_masked")
    assert masked.count() == 0  # no groups: the row filter hides every plant


def test_write_table_dynamic_overwrite_and_compact(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40).select((F.col("id") % 4).alias("p"), F.col("id"))
    assert write_table(df.repartition(8), path, partition_by=("p",)) == 40
    one = df.filter("p = 1").withColumn("id", F.col("id") * 100)
    assert write_table(one, path, partition_by=("p",), only_partitions=True) == 10
    back = spark.read.parquet(path)
    assert back.count() == 40 and back.filter("p = 1").agg(F.min("id")).first()[0] == 100
    out = compact(spark, path, target_files=1, partition_by=("p",))
    files = [f for d in os.listdir(out) if d.startswith("p=") for f in os.listdir(os.path.join(out, d))
             if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(out).count() == 40
    assert compact(spark, path, "p = 2", partition_by=("p",)) == path  # the other partitions stay
    assert spark.read.parquet(path).count() == 40
    assert write_table(one, path, partition_by=("p",)) == 10  # a full refresh leaves nothing of the old table
    assert spark.read.parquet(path).select("p").distinct().count() == 1


def test_read_table_takes_uris_and_sees_new_rows(spark, tmp_path):
    path = tmp_path / "events.parquet"
    spark.range(10).write.parquet(str(path))
    assert shims.read_table(spark, f"file://{tmp_path}", "events").count() == 10
    spark.range(5).write.mode("append").parquet(str(path))
    assert shims.read_table(spark, f"file://{tmp_path}", "events").count() == 15


def test_retention_job_writes_back(spark, tmp_path):
    raw = {name: fn(spark, SF_SMALL) for name, fn in shims.RAW_SHIMS.items()}
    root = str(tmp_path / "lake")
    rep = run_batch(spark, raw, root, as_of="2024-01-31 00:00:00")
    left = run_retention(spark, root, "2024-01-31 00:00:00")
    for name in ("work_order_people", "alarm_ack_people", "shift_people"):
        assert read_current(spark, f"{root}/ops_pii_restricted/{name}").count() == left[name]
    assert left["work_order_people"] < rep.rows["ops_pii_restricted.work_order_people"]
    bronze = read_current(spark, f"{root}/bronze/work_orders_raw")
    assert bronze.count() == rep.rows["bronze.work_orders_raw"]  # the facts stay
    assert bronze.filter("technician_name is not null").count() == left["work_order_people"]
    people = os.path.join(root, "ops_pii_restricted", "shift_people")  # purged rows are on disk no more
    assert [d for d in os.listdir(people) if d.startswith("data-")] == [versions(spark, people)[-1][1]]


def test_shared_folder_must_be_named_on_a_cluster():
    from plantlake.session import shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_catalogue_lists_registered_tables(spark, tmp_path):
    from plantlake.plans.tables import create_databases
    create_databases(spark, str(tmp_path / "wh"), ("gold",))
    path = str(tmp_path / "wh" / "gold" / "x")
    write_table(spark.range(3), path, table="gold.x_probe")
    cat = catalogue(spark, ("gold",))
    assert {(r.table_name, r.column_name) for r in cat.collect()} >= {("x_probe", "id")}


def test_sql_functions(spark):
    from plantlake.functions import register_sql_functions
    register_sql_functions(spark, ["plant_PLANT-01"])
    r = spark.sql("SELECT mask_email('jordan.lee@example.com') e, mask_phone('+1-555-0101') p, mask_name(NULL) n, "
                  "plant_filter('PLANT-01') a, plant_filter('PLANT-02') b, plant_filter(NULL) c").first()
    assert tuple(r) == ("j***@example.com", "***-***-0101", "REDACTED", True, False, False)
    register_sql_functions(spark, ["pii_readers"])
    r = spark.sql("SELECT mask_email('x@y.z') e, plant_filter('PLANT-09') a").first()
    assert tuple(r) == ("x@y.z", True)


def test_only_running_and_split_midnight(spark, fx):
    from plantlake.schemas import POINTS_RAW_SCHEMA
    t = dt.datetime(2026, 8, 10, 6, 0)
    def p(s, v, m):
        return ("\\\\P\\A|" + s, "A", t + dt.timedelta(minutes=m), v, "Good", "u", "mock_pi", "P", "AR", t, None)
    pts = silver.silver_points(spark.createDataFrame(
        [p("RunStatus", 1.0, 0), p("Vibration", 3.0, 0), p("RunStatus", 0.0, 10), p("Vibration", 0.0, 10)],
        POINTS_RAW_SCHEMA))
    vib = lambda df: df.filter("tag_suffix = 'Vibration'").first().avg_value
    assert vib(gold.tag_hourly(pts)) == 1.5
    assert vib(gold.tag_hourly(pts, only_running=True)) == 3.0
    ev = spark.createDataFrame([("E", "P", "AR", "L", "A", dt.datetime(2026, 8, 10, 22), dt.datetime(2026, 8, 11, 2),
                                 "RUN", None, 10, 1, 12, "n")],
                               "event_id string, plant_id string, area_id string, line_id string, asset_id string, "
                               "event_start timestamp, event_end timestamp, event_type string, downtime_code string, "
                               "good_count bigint, scrap_count bigint, planned_count bigint, notes string")
    whole = {str(r.day_dt): r.run_hours for r in gold.oee_daily(ev).collect()}
    split = {str(r.day_dt): (r.run_hours, r.good_count) for r in gold.oee_daily(ev, split_midnight=True).collect()}
    assert whole == {"2026-08-10": 4.0}
    assert split == {"2026-08-10": (2.0, 10), "2026-08-11": (2.0, 0)}


def test_compact_splits_a_hot_partition(spark, tmp_path):
    path = str(tmp_path / "hot")
    # partition p=0 holds two thirds of the rows
    df = spark.range(300_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 5 + 1).alias("p"),
                                     F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    write_table(df.repartition(16), path, partition_by=("p",))
    # small split and advisory sizes stand in for a large table: many map tasks, 1 MB target
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(1 << 20),
             "spark.sql.files.maxPartitionBytes": str(256 << 10), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = compact(spark, path, partition_by=("p",))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = [f for f in os.listdir(os.path.join(out, "p=0")) if f.endswith(".parquet")]
    assert len(hot) > 1  # split across tasks, not one writer for the hot partition
    back = spark.read.parquet(out)
    assert back.count() == 300_000 and back.filter("p = 0").count() == 200_000
