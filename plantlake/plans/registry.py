"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, maps the driver's tables to plant
inputs (:mod:`plantlake.sources.shims`), runs the operators and returns a
DataFrame.  Values that depend on summation order (averages, standard
deviations, slopes, sums of doubles) are presented rounded with
:func:`round6`; ratios of integer sums are left exact.  Lists are presented
as sorted, comma-joined strings.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLASSIFIED, REFERENCE_POLICY, REFERENCE_REDACT_NAMES
from ..functions import register_sql_functions, round6
from ..operators import diagnostics as dgn
from ..operators import gold, governance, metrics, quality, serving, silver, tools
from ..schemas import CSV_COLUMNS
from ..session import configure, shared_dir, ship_package
from ..sources import shims
from ..sources.csv import load_csv, load_csv_versions, rescued_cells
from ..sources.points import bronze_points, parse_messages
from ..sources.pysource import PointPollSource
from .changes import apply_changes, table_changes
from .intervals import overlap_check
from .pipeline import run_batch
from .tables import catalogue, compact, create_databases, define_raw_tables, write_table
from .versions import read_current, replace_table

AS_OF = "2024-01-31 00:00:00"
LATE_AS_OF = "2024-01-30 12:00:00"
SHIFT_AS_OF = "2024-01-05 09:00:00"
SALT = "plantlake-v1"


class Inputs:
    """Plant-shaped frames derived lazily from the driver's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return shims.RAW_SHIMS[name](self.spark, self.sf_dir)

    @cached_property
    def points_raw(self):
        return self.raw("points_raw")

    @cached_property
    def assets_raw(self):
        return self.raw("assets_raw")

    @cached_property
    def work_orders_raw(self):
        return self.raw("work_orders_raw")

    @cached_property
    def alarms_raw(self):
        return self.raw("alarms_raw")

    @cached_property
    def production_events_raw(self):
        return self.raw("production_events_raw")

    @cached_property
    def shifts_raw(self):
        return self.raw("shifts_raw")

    # silver
    @cached_property
    def points(self):
        return silver.silver_points(self.points_raw)

    @cached_property
    def assets(self):
        return silver.silver_assets(self.assets_raw)

    @cached_property
    def work_orders(self):
        return silver.silver_work_orders(self.work_orders_raw)

    @cached_property
    def alarms(self):
        return silver.silver_alarms(self.alarms_raw)

    @cached_property
    def production_events(self):
        return silver.silver_production_events(self.production_events_raw)

    @cached_property
    def shifts(self):
        return silver.silver_shifts(self.shifts_raw)

    @cached_property
    def work_order_people(self):
        return silver.work_order_people(self.work_orders_raw)

    @cached_property
    def alarm_ack_people(self):
        return silver.alarm_ack_people(self.alarms_raw)

    @cached_property
    def shift_people(self):
        return silver.shift_people(self.shifts_raw)

    # gold
    @cached_property
    def hourly(self):
        return gold.tag_hourly(self.points)

    @cached_property
    def health(self):
        return gold.health_daily(self.hourly, self.assets)

    @cached_property
    def outcomes(self):
        return gold.maintenance_outcomes(self.work_orders)

    @cached_property
    def oee(self):
        return gold.oee_daily(self.production_events)

    # metrics / serving
    @cached_property
    def health_metric(self):
        return metrics.asset_health_score(self.health)

    @cached_property
    def s_work_orders(self):
        return serving.serving_work_orders(self.work_orders)

    @cached_property
    def s_alarms(self):
        return serving.serving_alarms(self.alarms)

    @cached_property
    def s_shifts(self):
        return serving.serving_shifts(self.shifts)

    @cached_property
    def s_outcomes(self):
        return serving.serving_outcomes(self.outcomes)

    @cached_property
    def s_production(self):
        return serving.serving_production_events(self.production_events)

    @cached_property
    def points_recent(self):
        return serving.points_recent(self.points, 7, AS_OF)


def present(df: DataFrame, rounded=(), joined=()) -> DataFrame:
    """Round order-dependent doubles; join arrays to sorted strings."""
    cols = []
    for c in df.columns:
        if c in rounded:
            cols.append(round6(c).alias(c))
        elif c in joined:
            cols.append(F.array_join(F.sort_array(F.col(c)), ",").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


HEALTH_ROUND = ("vib", "bearing_temp", "motor_amps", "run_frac", "health_score")
METRIC_ROUND = ("vibration_avg", "bearing_temp", "motor_amps", "health_score")
POINT_COLS = ("tag_name", "asset_id", "event_ts", "value", "quality", "uom", "source_system",
              "plant_id", "area_id", "ingest_ts")


def _q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


Q: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# -- silver / PII ----------------------------------------------------------------

@query("silver_points")
def _silver_points(i: Inputs):
    """SLV-02."""
    return i.points


@query("silver_assets")
def _silver_assets(i: Inputs):
    """SLV-01, SRV-04."""
    return serving.serving_assets(i.assets)


@query("silver_work_orders")
def _silver_work_orders(i: Inputs):
    """SLV-03."""
    return i.work_orders


@query("silver_alarms")
def _silver_alarms(i: Inputs):
    """SLV-04."""
    return i.alarms


@query("silver_production")
def _silver_production(i: Inputs):
    """SLV-05."""
    return i.production_events


@query("silver_shifts")
def _silver_shifts(i: Inputs):
    """SLV-06."""
    return i.shifts


@query("pii_split_orders")
def _pii_orders(i: Inputs):
    """PII-01."""
    return i.work_order_people


@query("pii_split_alarms")
def _pii_alarms(i: Inputs):
    """PII-02."""
    return i.alarm_ack_people


@query("pii_split_shifts")
def _pii_shifts(i: Inputs):
    """PII-03."""
    return i.shift_people


# -- gold / metrics ----------------------------------------------------------------

@query("tag_hourly")
def _tag_hourly(i: Inputs):
    """GLD-01."""
    return present(i.hourly, rounded=("avg_value", "std_value"))


@query("health_daily")
def _health_daily(i: Inputs):
    """GLD-02, GLD-03, SRV-05."""
    return present(serving.serving_health(i.health), rounded=HEALTH_ROUND)


@query("health_metric")
def _health_metric(i: Inputs):
    """MET-01."""
    return present(i.health_metric, rounded=METRIC_ROUND)


@query("anomaly_rate")
def _anomaly_rate(i: Inputs):
    """MET-02."""
    return metrics.anomaly_rate(i.health, 7, AS_OF)


@query("maintenance_outcomes")
def _outcomes(i: Inputs):
    """GLD-04, SRV-07."""
    return i.s_outcomes


@query("mtbf_proxy")
def _mtbf(i: Inputs):
    """MET-03."""
    return present(metrics.mtbf_proxy(i.outcomes), rounded=("avg_mttr_hours",))


@query("oee_daily")
def _oee(i: Inputs):
    """GLD-05, SRV-06."""
    return serving.serving_oee(i.oee)


@query("oee_by_line")
def _oee_by_line(i: Inputs):
    """MET-04."""
    return metrics.oee_by_line(i.oee)


# -- serving ------------------------------------------------------------------------

@query("serving_work_orders")
def _s_wo(i: Inputs):
    """SRV-01."""
    return i.s_work_orders


@query("serving_alarms")
def _s_alarms(i: Inputs):
    """SRV-02."""
    return i.s_alarms


@query("serving_shifts")
def _s_shifts(i: Inputs):
    """SRV-03 (reference name list)."""
    return i.s_shifts


@query("serving_shifts_dictionary")
def _s_shifts_dict(i: Inputs):
    """SRV-03 with the name dictionary taken from the people tables (token join)."""
    names = serving.names_from_people(i.shift_people, i.work_order_people)
    return serving.serving_shifts(i.shifts, names)


@query("points_recent")
def _points_recent(i: Inputs):
    """SRV-08."""
    return i.points_recent


# -- governance -----------------------------------------------------------------------

@query("mask_people")
def _mask_people(i: Inputs):
    """GOV-01..04: shift people as seen by a member of plant_PLANT-01 (reference policy)."""
    return governance.secure_view(i.shift_people, "shift_people", ["plant_PLANT-01"], REFERENCE_POLICY)


@query("plant_rows")
def _plant_rows(i: Inputs):
    """GOV-05/06: order people for members of two plants."""
    return governance.secure_view(i.work_order_people, "work_order_people",
                                  ["plant_PLANT-02", "plant_PLANT-03"], REFERENCE_POLICY)


@query("leak_audit")
def _leak_audit(i: Inputs):
    """GOV-08: emails, phones and known names per text column."""
    tables = {
        "documents": shims.documents(i.spark, i.sf_dir),
        "serving_shifts": i.s_shifts,
        "serving_alarms": i.s_alarms,
        "serving_work_orders": i.s_work_orders,
    }
    return governance.leak_audit(tables, names=REFERENCE_REDACT_NAMES)


@query("classified_values")
def _classified(i: Inputs):
    """GOV-07: the classification registry with the number of values each classified column holds."""
    parts = []
    for table in dict.fromkeys(t for t, *_ in CLASSIFIED):
        df = getattr(i, table)
        cols = [c for t, c, *_ in CLASSIFIED if t == table]
        wide = df.agg(*[F.count(c).alias(c) for c in cols])
        stacked = ", ".join(f"named_struct('column_name', '{c}', 'filled', `{c}`)" for c in cols)
        parts.append(wide.selectExpr(f"'{table}' AS table_name", f"inline(array({stacked}))"))
    counts = parts[0].union(parts[1]).union(parts[2])
    registry = governance.classification(i.spark).select("table_name", "column_name", "pii", "retention_days")
    return registry.join(counts, ["table_name", "column_name"])


@query("masks_sql")
def _masks_sql(i: Inputs):
    """UDF-01/02: the SQL functions, called from SQL."""
    register_sql_functions(i.spark, ["plant_PLANT-01"])
    i.shift_people.createOrReplaceTempView("plantlake_shift_people")
    return i.spark.sql(
        "SELECT shift_id, mask_email(supervisor_email) AS supervisor_email, mask_phone(supervisor_phone) AS "
        "supervisor_phone, mask_name(supervisor_name) AS supervisor_name, plant_filter(plant_id) AS mine "
        "FROM plantlake_shift_people")


@query("retention")
def _retention(i: Inputs):
    """GOV-09: kept / purged people rows as of AS_OF."""
    people = {"work_order_people": i.work_order_people, "alarm_ack_people": i.alarm_ack_people,
              "shift_people": i.shift_people}
    facts = {"work_order_people": i.work_orders, "alarm_ack_people": i.alarms, "shift_people": i.shifts}
    return governance.retention_report(people, facts, AS_OF)


@query("pseudonymise")
def _pseudo(i: Inputs):
    """GOV-10."""
    return governance.pseudonymise(
        i.shifts.select("shift_id", "supervisor_employee_id", "operator_employee_id"),
        ["supervisor_employee_id", "operator_employee_id"], SALT)


@query("identity_lookup")
def _identity(i: Inputs):
    """GOV-11: privileged lookup of on-call open orders to technicians."""
    facts = i.work_orders.filter((F.col("status") == "OPEN") & (F.col("priority") <= 1)).select(
        "work_order_id", "asset_id", "plant_id", "priority")
    people = i.work_order_people.select("work_order_id", "plant_id", "technician_name", "technician_email")
    return governance.identity_lookup(facts, people, "work_order_id", "work_order_people",
                                      [REFERENCE_POLICY.privileged_group])


# -- tools -------------------------------------------------------------------------

@query("unhealthy_assets")
def _t01(i: Inputs):
    """TOOL-01."""
    return present(tools.list_unhealthy_assets(i.health_metric, None, 70), rounded=METRIC_ROUND)


@query("asset_health")
def _t02(i: Inputs):
    """TOOL-02."""
    return present(serving.serving_health(tools.get_asset_health(i.health, None, 7, AS_OF)), rounded=HEALTH_ROUND)


@query("open_orders")
def _t03(i: Inputs):
    """TOOL-03."""
    return tools.list_open_work_orders(i.s_work_orders)


@query("asset_anomaly_rate")
def _t04(i: Inputs):
    """TOOL-04."""
    return tools.get_anomaly_rate(i.health, None, 7, AS_OF)


@query("asset_mtbf")
def _t05(i: Inputs):
    """TOOL-05."""
    return present(tools.get_mtbf_proxy(i.outcomes, None), rounded=("avg_mttr_hours",))


@query("alarms_in_window")
def _t06(i: Inputs):
    """TOOL-06."""
    return tools.get_alarms_in_window(i.s_alarms, None, "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query("tag_series")
def _t07(i: Inputs):
    """TOOL-07."""
    return tools.get_tag_series(i.points_recent, None, "Vibration", "2024-01-24 00:00:00", AS_OF)


@query("downtime_events")
def _t08(i: Inputs):
    """TOOL-08."""
    return tools.get_downtime_events(i.s_production, None, "1996-01-01 00:00:00", "1997-12-31 00:00:00")


@query("recent_failures")
def _t09(i: Inputs):
    """TOOL-09."""
    return tools.get_recent_failures(i.s_outcomes, None, 10)


@query("shift_context")
def _t10(i: Inputs):
    """TOOL-10."""
    return tools.get_shift_context(i.s_shifts, None, None, SHIFT_AS_OF)


@query("overnight_anomalies")
def _t11(i: Inputs):
    """TOOL-11."""
    return tools.list_overnight_anomalies(i.health, i.s_alarms, None, 48, LATE_AS_OF)


@query("priority_orders")
def _t12(i: Inputs):
    """TOOL-12."""
    return tools.list_open_high_priority_wos(i.s_work_orders, None)


@query("active_alarms")
def _t13(i: Inputs):
    """TOOL-13."""
    return tools.list_active_alarms(i.s_alarms, None)


@query("advisor_evidence")
def _t14(i: Inputs):
    """TOOL-14."""
    return present(tools.advisor_evidence(i.health_metric, i.s_work_orders), rounded=("health_score",))


@query("rca_evidence")
def _t15(i: Inputs):
    """TOOL-15 (bucketed range join)."""
    win = tools.incident_windows(i.s_alarms)
    return tools.rca_evidence(win, i.s_alarms, i.points, i.s_production, i.s_outcomes, bucketed=True)


@query("rca_alarms")
def _t15a(i: Inputs):
    """TOOL-15 alarm evidence, long form (window, alarm)."""
    return tools.rca_alarms(tools.incident_windows(i.s_alarms), i.s_alarms, bucketed=True)


@query("shift_brief")
def _t16(i: Inputs):
    """TOOL-16 (long form)."""
    return tools.shift_brief(i.s_shifts, i.health, i.s_alarms, i.s_work_orders, i.assets, None, None, 12,
                             SHIFT_AS_OF)


@query("health_trend")
def _t17(i: Inputs):
    """TOOL-17."""
    return present(tools.health_trend(i.health, None, 7, AS_OF),
                   rounded=("health_score", "delta_prev", "trend_slope"))


@query("flagged_today")
def _t18(i: Inputs):
    """TOOL-18."""
    return present(serving.serving_health(tools.flagged_today(i.health, LATE_AS_OF)), rounded=HEALTH_ROUND)


@query("critical_open_orders")
def _t19(i: Inputs):
    """TOOL-19."""
    return tools.critical_open_orders(i.s_work_orders, i.assets, "A")


@query("compare_lines")
def _t20(i: Inputs):
    """TOOL-20."""
    return present(tools.compare_lines(i.oee), rounded=("mean_daily_oee", "pooled_oee"))


@query("high_alarms")
def _t21(i: Inputs):
    """TOOL-21."""
    return tools.high_alarms(i.s_alarms)


@query("nominal_deviation")
def _t22(i: Inputs):
    """TOOL-22."""
    return present(tools.nominal_deviation(i.hourly, tools.tag_dimension(i.spark)),
                   rounded=("avg_value", "deviation_pct"))


@query("ingest_status")
def _t23(i: Inputs):
    """TOOL-23."""
    return tools.ingest_status(i.points_raw)


# -- diagnostics / quality -----------------------------------------------------------

@query("freshness")
def _dgn01(i: Inputs):
    """DGN-01."""
    return dgn.freshness(i.points_raw)


@query("latest_points")
def _dgn02(i: Inputs):
    """DGN-02."""
    return dgn.latest_points(i.points_raw.select(*POINT_COLS), 50)


@query("health_list")
def _dgn03(i: Inputs):
    """DGN-03."""
    return present(dgn.health_list(serving.serving_health(i.health), 50), rounded=HEALTH_ROUND)


@query("table_counts")
def _dgn04(i: Inputs):
    """DGN-04."""
    return dgn.table_counts({n: getattr(i, n) for n in shims.RAW_SHIMS})


@query("contract_check")
def _dq01(i: Inputs):
    """DQ-01."""
    return quality.contract_summary(i.points_raw)


@query("quarantined_points")
def _dq01_rows(i: Inputs):
    """DQ-01: the rejected points with their reason."""
    return quality.check_contract(i.points_raw)[1].select(
        "tag_name", "asset_id", "event_ts", "value", "quality", "uom", "reject_reason")


@query("cast_quarantine")
def _dq02(i: Inputs):
    """DQ-02."""
    out = None
    for name, casts in quality.CASTS.items():
        part = quality.cast_failures(getattr(i, f"{name}_raw"), name, casts)
        out = part if out is None else out.unionByName(part)
    return out


@query("key_check")
def _dq03(i: Inputs):
    """DQ-03."""
    parts = [
        quality.key_summary(i.assets, "assets", ["asset_id", "plant_id"]),
        quality.key_summary(i.work_orders, "work_orders", ["work_order_id"], i.assets),
        quality.key_summary(i.alarms, "alarms", ["alarm_id"], i.assets),
        quality.key_summary(i.production_events, "production_events", ["event_id"], i.assets),
        quality.key_summary(i.shifts, "shifts", ["shift_id"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("interval_check")
def _dq04(i: Inputs):
    """DQ-04."""
    return (quality.interval_check(i.work_orders, "work_orders", "opened_at", "closed_at")
            .unionByName(quality.interval_check(i.alarms, "alarms", "raised_at", "cleared_at"))
            .unionByName(quality.interval_check(i.production_events, "production_events", "event_start", "event_end"))
            .unionByName(quality.interval_check(i.shifts, "shifts", "shift_start", "shift_end")))


@query("overlap_check")
def _dq04_overlaps(i: Inputs):
    """DQ-04: overlapping intervals, whose plain sums count an instant more than once."""
    downtime = i.production_events.filter("event_type = 'DOWNTIME'")
    return (overlap_check(i.production_events, "production_events", list(gold.LINE), "event_start", "event_end")
            .unionByName(overlap_check(downtime, "downtime", ["plant_id", "asset_id"], "event_start", "event_end"))
            .unionByName(overlap_check(i.shifts, "shifts", ["plant_id", "area_id"], "shift_start", "shift_end"))
            .unionByName(overlap_check(i.alarms, "alarms", ["plant_id", "asset_id"], "raised_at", "cleared_at")))


@query("oee_once")
def _oee_once(i: Inputs):
    """GLD-05 with every instant counted once."""
    return present(gold.oee_once(i.production_events), rounded=("run_hours", "down_hours", "availability_ratio"))


@query("downtime_islands")
def _downtime_islands(i: Inputs):
    """TOOL-08, merged."""
    return tools.downtime_islands(i.production_events)


@query("alarm_context")
def _alarm_context(i: Inputs):
    """TOOL-07, TOOL-10 as of every alarm."""
    return tools.alarm_context(i.alarms, i.points, i.shifts, i.assets)


@query("tag_hourly_running")
def _tag_hourly_running(i: Inputs):
    """GLD-01 without readings of stopped assets (T5)."""
    return present(gold.tag_hourly(i.points, only_running=True), rounded=("avg_value", "std_value"))


def _versions(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Two stored versions of a table: work orders as they were, and after some closed, some were dropped, some came, and some came twice; a few
    have no id."""
    no = F.regexp_extract("work_order_id", r"(\d+)$", 1).cast("bigint")
    old = i.raw("work_orders_raw").withColumn("_no", no).withColumn(
        "work_order_id", F.when(F.col("_no") % 41 != 0, F.col("work_order_id")))
    new = old.filter("_no % 29 != 0").withColumn("status", F.when(F.col("_no") % 7 == 0, "CLOSED").otherwise(
        F.col("status"))).withColumn("notes", F.when(F.col("_no") % 31 != 0, F.col("notes")))
    added = old.filter("_no % 37 = 0").withColumn("work_order_id", F.concat(F.lit("NEW-"), F.col("_no").cast("string")))
    twice = old.filter("_no % 43 = 0")
    columns, root = [c for c in old.columns if c != "_no"], _folder(i, "versions")
    for name, version in (("old", old), ("new", new.union(added).union(twice))):
        write_table(version.select(columns), f"{root}/{name}")
    return i.spark.read.parquet(f"{root}/old"), i.spark.read.parquet(f"{root}/new")


@query("table_changes")
def _table_changes(i: Inputs):
    """SRC-09: the change rows between two versions of the work orders."""
    return table_changes(*_versions(i), ["work_order_id"])


@query("changes_applied")
def _changes_applied(i: Inputs):
    """SRC-09: the old version after its change rows."""
    old, new = _versions(i)
    return apply_changes(old, table_changes(old, new, ["work_order_id"]))


# -- sources and sinks over the shared folder -----------------------------------------

def _folder(i: Inputs, kind: str) -> str:
    return shared_dir(i.spark, kind, uuid.uuid4().hex)


def _csv_query(name: str):
    def run(i: Inputs):
        root = _folder(i, "csv")
        i.raw(f"{name}_raw").write.option("header", True).csv(f"{root}/{name}.csv")
        return load_csv(i.spark, f"{root}/{name}.csv", name, file_name=f"{name}.csv").drop("ingest_ts")
    run.__doc__ = f"SRC-01..03, SNK-02, BRZ-05: the {name} frame landed as CSV and loaded again."
    return run


for _name in CSV_COLUMNS:
    Q[f"csv_{_name}"] = _csv_query(_name)


def _landed_versions(i: Inputs) -> DataFrame:
    """Work orders as they land over the years, in files of four kinds by id: the declared header; the columns in
    reverse; a new vendor column and no notes; and lines with one cell too many or the last one missing."""
    root, columns = _folder(i, "csv"), list(CSV_COLUMNS["work_orders"])
    no = F.regexp_extract("work_order_id", r"(\d+)$", 1).cast("bigint")
    raw = i.raw("work_orders_raw").withColumn("_no", no).withColumn("vendor", F.concat(F.lit("V,"), F.col("_no")))
    reverse, vendor = columns[::-1], ["vendor", *[c for c in columns if c != "notes"]]
    for kind, header in enumerate((columns, reverse, vendor)):
        raw.filter(F.col("_no") % 4 == kind).select(header).write.option("header", True).option("escape", '"').csv(
            f"{root}/kind-{kind}")
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in columns]
    line = F.when(F.col("_no") % 8 == 3, F.concat_ws(",", *quoted, F.lit("late"))).otherwise(
        F.concat_ws(",", *quoted[:-1]))
    lines = raw.filter("_no % 4 = 3").select(line.alias(",".join(columns)))
    # Whole lines: no quoting, and a separator that no line holds.
    (lines.write.option("header", True).option("sep", "\x01").option("quote", "\x00")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/kind-3"))
    return load_csv_versions(i.spark, root, "work_orders")


@query("csv_versions")
def _csv_versions(i: Inputs):
    """SRC-01, SNK-02: files of several header versions, and broken lines, loaded without loss."""
    return _landed_versions(i).drop("ingest_ts", "source_file")


@query("csv_rescued")
def _csv_rescued(i: Inputs):
    """SRC-01: rescued rows by unknown column."""
    return rescued_cells(_landed_versions(i)).groupBy("column_name").agg(F.sum("rows").alias("rows"))


@query("poll_replay")
def _poll_replay(i: Inputs):
    """SRC-05 (b), STR-04: polls kept in the shared folder, read back by a second query whose endpoints are gone.

    One endpoint per plant; a poll's payload is the plant's landed messages.
    """
    ship_package(i.spark)
    i.spark.dataSource.register(PointPollSource)
    root = _folder(i, "poll")
    plant = F.coalesce(F.get_json_object("value", "$[0].plant_id"), F.lit("none"))
    shims.point_messages(i.spark, i.sf_dir).select("value", plant.alias("plant")).write.partitionBy("plant").text(
        f"{root}/plants")
    plants = i.spark.read.text(f"{root}/plants").select("plant").distinct().collect()
    options = {"endpoints": ",".join(sorted(f"{root}/plants/plant={r.plant}" for r in plants)), "ticks": "1",
               "store": f"{root}/store"}
    for run, fetcher in (("first", "plantlake.sources.pysource:file_fetch"), ("again", "no_such_module:fetch")):
        polled = i.spark.readStream.format("plant_points").options(fetcher=fetcher, **options).load()
        sink = (bronze_points(polled, dt.datetime(2024, 2, 1)).writeStream.format("parquet")
                .option("checkpointLocation", f"{root}/checkpoint-{run}").trigger(availableNow=True)
                .start(f"{root}/{run}"))
        sink.awaitTermination()
    return i.spark.read.parquet(f"{root}/again").select(*POINT_COLS)


@query("points_landing")
def _points_landing(i: Inputs):
    """SRC-05/07, BRZ-01..04, FN-18: messages landed as text, parsed, with landing time and payload."""
    folder = _folder(i, "landing")
    shims.point_messages(i.spark, i.sf_dir).select("value").write.text(folder)
    points = bronze_points(parse_messages(i.spark.read.text(folder)), dt.datetime(2024, 2, 1))
    payload = lambda key: F.get_json_object("raw_payload", f"$.{key}")
    return points.select(*POINT_COLS, payload("tag_name").alias("payload_tag"),
                         payload("quality").alias("payload_quality"))


def _by_date(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("event_date").agg(F.count(F.lit(1)).alias(name))


@query("table_sink")
def _table_sink(i: Inputs):
    """SNK-01, SNK-03, SNK-07: a full write by date, then a rebuild of its dates only (every row twice)."""
    path = _folder(i, "sink")
    points = i.points.withColumn("event_date", F.to_date("event_ts"))
    write_table(points, path, partition_by=("event_date",))
    again = path + "-again"
    write_table(points, again, partition_by=("event_date",))
    write_table(points.union(points), again, partition_by=("event_date",), only_partitions=True)
    return _by_date(i.spark.read.parquet(path), "rows").join(
        _by_date(i.spark.read.parquet(again), "rows_after_rebuild"), "event_date")


@query("table_replace")
def _table_replace(i: Inputs):
    """SNK-02, SNK-03: a table replaced under another schema; a third write that dies leaves the second version."""
    path = _folder(i, "replace")
    orders = i.raw("work_orders_raw")
    replace_table(orders.select("work_order_id", "status"), path)
    replace_table(read_current(i.spark, path).join(orders.select("work_order_id", "priority", "asset_id"),
                                                   "work_order_id"), path)
    dies = F.when(F.col("work_order_id").isNotNull(), F.raise_error(F.lit("lost"))).otherwise(F.lit(""))
    try:
        replace_table(orders.withColumn("status", dies), path)
    except Exception as e:  # noqa: BLE001 - this write is meant to fail
        if "lost" not in str(e):
            raise
    return read_current(i.spark, path)


@query("live_views")
def _live_views(i: Inputs):
    """SNK-04, SRV-01/02/04..07: persistent views of the whole batch pipeline, after its tables were replaced once."""
    root, prefix = _folder(i, "lake"), f"p{uuid.uuid4().hex[:8]}_"
    frames = {name: i.raw(name) for name in shims.RAW_SHIMS}
    run_batch(i.spark, frames, root, register=True, prefix=prefix)
    later = i.raw("alarms_raw").withColumn("alarm_id", F.concat(F.lit("again-"), "alarm_id"))
    replace_table(silver.silver_alarms(frames["alarms_raw"].union(later)), f"{root}/silver/alarms",
                  table=f"{prefix}silver.alarms")
    out = None
    for name in ("work_orders", "alarms", "assets", "production_events", "asset_health_daily", "oee_daily",
                 "maintenance_outcomes"):
        view = i.spark.table(f"{prefix}serving_safe.{name}")
        part = view.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("view_name"), "rows", F.lit(len(view.columns)).alias("n_columns"))
        out = part if out is None else out.union(part)
    return out


@query("table_compact")
def _table_compact(i: Inputs):
    """SNK-01: small files rewritten by the advisory size."""
    path = _folder(i, "compact")
    write_table(i.points.withColumn("event_date", F.to_date("event_ts")), path, partition_by=("event_date",))
    return _by_date(i.spark.read.parquet(compact(i.spark, path, partition_by=("event_date",))), "rows")


@query("bronze_tables")
def _bronze_tables(i: Inputs):
    """SNK-05, SNK-06, SNK-08: raw tables under their declared schemas, filled, and listed from the catalogue."""
    root, db = _folder(i, "lake"), f"bronze_{uuid.uuid4().hex[:8]}"
    create_databases(i.spark, root, (db,))
    out = None
    for table in define_raw_tables(i.spark, root, db):
        raw = i.raw("points_raw" if table == "pi_timeseries_raw" else table)
        if table != "pi_timeseries_raw":
            raw = raw.withColumns({"ingest_ts": F.lit(AS_OF).cast("timestamp"), "source_file": F.lit(table)})
        raw.select(*i.spark.table(f"{db}.{table}").columns).write.insertInto(f"{db}.{table}")
        part = i.spark.table(f"{db}.{table}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), "rows")
        out = part if out is None else out.union(part)
    columns = catalogue(i.spark, (db,)).groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("n_columns"))
    return columns.join(out, "table_name")


@query("batch_tables")
def _batch_tables(i: Inputs):
    """SNK-01..08: the whole batch pipeline into the shared folder; rows read back from some of its tables."""
    root = _folder(i, "lake")
    run_batch(i.spark, {name: i.raw(name) for name in shims.RAW_SHIMS}, root, as_of=AS_OF)
    out = None
    for table in ("bronze.pi_timeseries_raw", "silver.pi_timeseries", "silver.work_orders", "silver.shifts",
                  "gold.asset_tag_hourly", "gold.asset_health_daily", "gold.maintenance_outcomes", "gold.oee_daily",
                  "metrics.asset_health_score", "serving_safe.alarms", "serving_safe.shifts",
                  "serving_safe.pi_timeseries_recent"):
        part = read_current(i.spark, f"{root}/{table.replace('.', '/')}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), "rows")
        out = part if out is None else out.union(part)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _q(fn) for name, fn in Q.items()}
    from ..streaming import registry_entries
    out.update(registry_entries())
    return out


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: daily asset health (GLD-01..03) on the smallest data set."""
    return _q(_health_daily)(spark, sf_dir)
