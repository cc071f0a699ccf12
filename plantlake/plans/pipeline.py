"""Batch pipeline in the true order: bronze -> silver + people -> gold -> metrics/serving views.

Each layer is materialised, so lineage is cut at every table (an executor
lost late in the run recomputes from the last written table, not from the
sources).  Points, hourly facts and daily health are partitioned by date; a
run replaces every table whole, as a new version (:mod:`plans.versions`): a
table that a dead run did not finish stays as it was.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLASSIFIED, REFERENCE_POLICY, HealthRule, Policy
from ..operators import gold, governance, metrics, quality, serving, silver
from ..schemas import DATABASES
from ..session import configure
from .tables import create_databases
from .versions import define_live_views, drop_versions, read_current, replace_table


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    quarantined: dict[str, int] = field(default_factory=dict)


def run_batch(spark: SparkSession, raw: dict[str, DataFrame], root: str, rule: HealthRule = HealthRule(),
              policy: Policy = REFERENCE_POLICY, as_of: dt.datetime | str | None = None, fmt: str = "parquet",
              register: bool = False, prefix: str = "", keep: int = 2) -> RunReport:
    """Build every table from raw frames (keys: ``points_raw``, ``assets_raw``, ...).

    Returns row counts per written table and quarantine counts.  The metric
    and serving views are written into the ``metrics`` and ``serving_safe``
    databases, so that other sessions, and readers with rights on those
    databases only, find them; shift notes lose the names of the list and of
    the people tables.  With ``register`` every table gets a catalogue name
    (databases ``prefix`` + layer) that follows its current version, and
    without ``as_of`` the serving names that need no redaction become views
    that follow their tables and the clock.  The last ``keep`` versions of a
    table stay on disk.
    """
    configure(spark)
    rep = RunReport()
    written: list[str] = []
    root = root.rstrip("/")
    if register:
        create_databases(spark, root, [prefix + db for db in DATABASES])

    def save(df: DataFrame, layer: str, name: str, partition_by=()) -> DataFrame:
        path = f"{root}/{layer}/{name}"
        table = f"{prefix}{layer}.{name}" if register else None
        rep.rows[f"{layer}.{name}"] = replace_table(df, path, partition_by, fmt, table)
        written.append(path)
        return read_current(spark, path, fmt)

    def quarantine(df: DataFrame, name: str) -> int:
        written.append(f"{root}/quarantine/{name}")
        return replace_table(df, written[-1], (), fmt)

    # bronze: points keep every row (quarantine is reported, not dropped here)
    points_raw = save(raw["points_raw"].withColumn("event_date", F.to_date("event_ts")), "bronze",
                      "pi_timeseries_raw", ("event_date",))
    rep.quarantined["pi_timeseries_raw"] = quarantine(quality.check_contract(points_raw)[1], "pi_timeseries")
    landed = {}
    for name in ("assets", "work_orders", "alarms", "production_events", "shifts"):
        landed[f"{name}_raw"] = save(raw[f"{name}_raw"], "bronze", f"{name}_raw")
        failed = quality.cast_quarantine(landed[f"{name}_raw"], quality.CASTS[name])[1]
        rep.quarantined[f"{name}_raw"] = quarantine(failed, name)

    # silver + people
    pts = save(silver.silver_points(points_raw).withColumn("event_date", F.to_date("event_ts")), "silver",
               "pi_timeseries", ("event_date",))
    sv = {name: save(fn(landed[f"{name}_raw"]), "silver", name) for name, fn in silver.SILVER_BUILDERS.items()}
    people = {name: save(fn(landed[f"{src}_raw"]), "ops_pii_restricted", name)
              for name, (src, fn) in silver.PEOPLE_BUILDERS.items()}

    # gold
    hourly = save(gold.tag_hourly(pts).withColumn("event_date", F.to_date("hour_ts")), "gold",
                  "asset_tag_hourly", ("event_date",))
    health = save(gold.health_daily(hourly, sv["assets"], rule), "gold", "asset_health_daily", ("day_dt",))
    outcomes = save(gold.maintenance_outcomes(sv["work_orders"]), "gold", "maintenance_outcomes")
    oee = save(gold.oee_daily(sv["production_events"]), "gold", "oee_daily")

    # metric and serving objects: the list's names first, then those of the people tables
    listed = serving.redact_names(sv["shifts"], "handoff_notes")
    names = serving.names_from_people(*people.values())
    views = {
        "metrics.asset_health_score": metrics.asset_health_score(health),
        "metrics.anomaly_rate_7d": metrics.anomaly_rate(health, 7, as_of),
        "metrics.mtbf_proxy": metrics.mtbf_proxy(outcomes),
        "metrics.oee_by_line": metrics.oee_by_line(oee),
        "serving_safe.work_orders": serving.serving_work_orders(sv["work_orders"]),
        "serving_safe.alarms": serving.serving_alarms(sv["alarms"]),
        "serving_safe.shifts": serving.serving_shifts(listed, names),
        "serving_safe.assets": serving.serving_assets(sv["assets"]),
        "serving_safe.asset_health_daily": serving.serving_health(health),
        "serving_safe.oee_daily": serving.serving_oee(oee),
        "serving_safe.maintenance_outcomes": serving.serving_outcomes(outcomes),
        "serving_safe.pi_timeseries_recent": serving.points_recent(pts, 7, as_of),
        "serving_safe.production_events": serving.serving_production_events(sv["production_events"]),
    }
    for name, df in views.items():
        save(df, *name.split("."))
    for name, df in people.items():
        governance.secure_view(df, name, (), policy).createOrReplaceTempView(f"{name}_masked")
    if register and as_of is None:
        define_live_views(spark, prefix)
    for path in written:
        drop_versions(spark, path, keep)
    return rep


def run_retention(spark: SparkSession, root: str, as_of: dt.datetime | str | None = None,
                  fmt: str = "parquet") -> dict[str, int]:
    """GOV-09 as a job: people rows past their time go, and raw rows lose their classified columns.

    A result is the table's next version, and replaces it only when it is
    complete; the files of older versions, which still hold what was purged,
    are deleted after that.  Returns the people rows left per table.
    """
    root = root.rstrip("/")
    load = lambda table: read_current(spark, f"{root}/{table}", fmt)

    def replace(df: DataFrame, table: str) -> int:
        rows = replace_table(df, f"{root}/{table}", (), fmt)
        drop_versions(spark, f"{root}/{table}")
        return rows

    left = {}
    for name, (src, _) in silver.PEOPLE_BUILDERS.items():
        fact = load(f"silver/{src}")
        left[name] = replace(governance.purge(load(f"ops_pii_restricted/{name}"), fact, name, as_of),
                             f"ops_pii_restricted/{name}")
        personal = [c for t, c, pii, *_ in CLASSIFIED if t == name and pii != "quasi"]
        judged = governance.retention_verdicts(load(f"bronze/{src}_raw"), fact, name, as_of)
        replace(judged.withColumns({c: F.when(F.col("verdict") == "keep", F.col(c)) for c in personal}).drop("verdict"),
                f"bronze/{src}_raw")
    return left
