"""Whole-or-nothing table replacement (SNK-02/03) and persistent views (SNK-04).

A versioned table is a folder with one sub-folder per version and a ledger
(``versions``) of empty files whose names list the complete ones.  A
replacement writes a new folder, and only then creates its ledger file, which
is there or not (one create, no rename): a reader sees the old table or the
new one, and a run that dies while it writes leaves the old one in place.  Files of a version
never change, so a reader that began before the switch finishes on its
version until :func:`drop_versions` removes it.  The new version may have
other columns.  One writer per table at a time; of two with the same number
all readers pick the same one.

The catalogue name, where one is given, is a view on the version's folder,
replaced by one catalogue call after the ledger file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .tables import write_table

def _store(spark: SparkSession, path: str):
    """(the file system of ``path``, the path) as Spark itself resolves them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(number, folder under ``path``, rows) of the complete versions, the current one last."""
    store, ledger = _store(spark, f"{path}/versions")
    if not store.exists(ledger):
        return []
    out = []
    for status in store.listStatus(ledger):
        number, mark, rows = status.getPath().getName().split(".")
        out.append((int(number), f"data-{number}-{mark}", int(rows)))
    return sorted(out)


def replace_table(df: DataFrame, path: str, partition_by=(), fmt: str = "parquet", table: str | None = None) -> int:
    """Write ``df`` as the next version of the table at ``path``, make it the current one, return its rows.

    ``df`` may read the table's current version.  With ``table`` the catalogue
    name is a view on the new version; a plain table of that name makes way
    for it (its files stay).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    known = versions(spark, path)
    number = known[-1][0] + 1 if known else 1
    mark = uuid.uuid4().hex[:12]
    folder = f"data-{number:06d}-{mark}"
    rows = write_table(df, f"{path}/{folder}", "errorifexists", partition_by, fmt)
    store, entry = _store(spark, f"{path}/versions/{number:06d}.{mark}.{rows}")
    store.create(entry, False).close()
    if table:
        point_view(spark, table, f"{path}/{folder}", fmt)
    return rows


def point_view(spark: SparkSession, table: str, folder: str, fmt: str = "parquet") -> None:
    """SNK-04: the persistent view ``table`` on the files of ``folder``."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {fmt}.`{folder}`")


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of the table at ``path`` (a folder without a ledger is read as it is)."""
    path = path.rstrip("/")
    known = versions(spark, path)
    return spark.read.format(fmt).load(f"{path}/{known[-1][1]}" if known else path)


def drop_versions(spark: SparkSession, path: str, keep: int = 1, leftovers: bool = False) -> list[str]:
    """Delete the files of all but the last ``keep`` versions; returns the folders removed.

    ``leftovers`` also removes folders that never got a ledger file (runs that
    died); call it while no replacement is being written.
    """
    if keep < 1:
        raise ValueError("the current version is always kept")
    path = path.rstrip("/")
    known = [folder for _, folder, _ in versions(spark, path)]
    if not known:
        return []
    store, root = _store(spark, path)
    kept, gone = set(known[-keep:]), []
    for status in store.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in kept and (leftovers or name in known):
            store.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def define_live_views(spark: SparkSession, prefix: str = "") -> list[str]:
    """SNK-04, SRV-01/02/04..08: serving views that follow their tables.

    Each is a persistent view, in SQL text, on the catalogue names of the
    silver and gold layers (``prefix`` precedes every database name): another
    session sees it, a replaced table shows at once, and the recent points
    move with the clock.  Shift notes are not here: their redaction depends on
    the people tables, so they are a written table.
    """
    from ..config import DEFAULT_RECENT_DAYS, ROLE_ONCALL, ROLE_PLANNER, ROLE_TECHNICIAN
    from ..operators import serving as s
    cols = ", ".join
    role = (f"CASE WHEN priority <= 1 THEN '{ROLE_ONCALL}' WHEN priority = 2 THEN '{ROLE_TECHNICIAN}' "
            f"ELSE '{ROLE_PLANNER}' END AS technician_role")
    since = f"current_timestamp() - INTERVAL {DEFAULT_RECENT_DAYS} DAYS"
    views = {
        "work_orders": f"SELECT work_order_id, asset_id, plant_id, opened_at, closed_at, status, failure_code, "
                       f"priority, {role}, parts_used, labor_hours FROM {prefix}silver.work_orders",
        "alarms": "SELECT alarm_id, asset_id, plant_id, raised_at, cleared_at, severity, alarm_code, alarm_text, "
                  f"acked_at, acked_by_employee_id IS NOT NULL AS was_acked FROM {prefix}silver.alarms",
        "assets": f"SELECT {cols(s.ASSET_COLUMNS)} FROM {prefix}silver.assets",
        "production_events": f"SELECT {cols(s.EVENT_COLUMNS)} FROM {prefix}silver.production_events",
        "asset_health_daily": f"SELECT {cols(s.HEALTH_COLUMNS)} FROM {prefix}gold.asset_health_daily",
        "oee_daily": f"SELECT {cols(s.OEE_COLUMNS)} FROM {prefix}gold.oee_daily",
        "maintenance_outcomes": f"SELECT {cols(s.OUTCOME_COLUMNS)} FROM {prefix}gold.maintenance_outcomes",
        "pi_timeseries_recent": f"SELECT {cols(s.POINT_COLUMNS)} FROM {prefix}silver.pi_timeseries "
                                f"WHERE event_ts >= {since} AND event_date >= to_date({since})",
    }
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}serving_safe.{name} AS {text}")
    return sorted(views)
