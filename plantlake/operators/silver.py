"""Silver projections and the vertical PII split (SLV-01..06, PII-01..03).

Each function maps one raw (bronze) frame to one typed frame.  Casts use
``try_cast`` so one bad text yields NULL instead of stopping the job (T11);
:func:`plantlake.operators.quality.cast_quarantine` reports such rows.
Silver keeps employee ids only; names, emails, phones and badges go to the
people frames and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SILVER_QUALITIES
from ..functions import as_timestamp, as_type, empty_to_null, tag_suffix
from .quality import reject_reason


def silver_assets(assets_raw: DataFrame) -> DataFrame:
    """SLV-01: 10 columns, typed install date, empty parent -> NULL."""
    return assets_raw.select(
        "plant_id", "area_id", "unit_id", "asset_id", "asset_name", "asset_type",
        "criticality", "manufacturer",
        as_type("install_date", "date").alias("install_date"),
        empty_to_null("parent_asset_id").alias("parent_asset_id"),
    )


def silver_points(points_raw: DataFrame, qualities=SILVER_QUALITIES, dedup: bool = False) -> DataFrame:
    """SLV-02: keep contract-valid points (DQ-01) of quality Good/Uncertain (Bad and NULL drop), add ``tag_suffix``.

    ``dedup`` drops repeated ``(tag_name, event_ts)`` readings (retried polls);
    off by default, as in the reference.
    """
    out = points_raw.filter(F.col("quality").isin(list(qualities)) & reject_reason().isNull()).select(
        "tag_name", "asset_id", "event_ts", "value", "quality", "uom", "source_system",
        "plant_id", "area_id", tag_suffix("tag_name").alias("tag_suffix"), "ingest_ts",
    )
    return out.dropDuplicates(["tag_name", "event_ts"]) if dedup else out


def silver_work_orders(work_orders_raw: DataFrame) -> DataFrame:
    """SLV-03: 12 columns; technician name/email/badge are left out."""
    return work_orders_raw.select(
        "work_order_id", "asset_id", "plant_id",
        as_timestamp("opened_at").alias("opened_at"),
        as_timestamp("closed_at").alias("closed_at"),
        "status", "failure_code",
        as_type("priority", "int").alias("priority"),
        "technician_employee_id",
        empty_to_null("parts_used").alias("parts_used"),
        as_type("labor_hours", "double").alias("labor_hours"),
        "notes",
    )


def silver_alarms(alarms_raw: DataFrame) -> DataFrame:
    """SLV-04: 10 columns; the acknowledger's name is left out."""
    return alarms_raw.select(
        "alarm_id", "asset_id", "plant_id",
        as_timestamp("raised_at").alias("raised_at"),
        as_timestamp("cleared_at").alias("cleared_at"),
        "severity", "alarm_code", "alarm_text",
        as_timestamp("acked_at").alias("acked_at"),
        "acked_by_employee_id",
    )


def silver_production_events(production_events_raw: DataFrame) -> DataFrame:
    """SLV-05: 13 columns, two timestamps and three BIGINT counts."""
    return production_events_raw.select(
        "event_id", "plant_id", "area_id", "line_id", "asset_id",
        as_timestamp("event_start").alias("event_start"),
        as_timestamp("event_end").alias("event_end"),
        "event_type",
        empty_to_null("downtime_code").alias("downtime_code"),
        as_type("good_count", "bigint").alias("good_count"),
        as_type("scrap_count", "bigint").alias("scrap_count"),
        as_type("planned_count", "bigint").alias("planned_count"),
        "notes",
    )


def silver_shifts(shifts_raw: DataFrame) -> DataFrame:
    """SLV-06: 10 columns; names, emails, phones dropped, notes kept raw."""
    return shifts_raw.select(
        "shift_id", "plant_id", "area_id", "shift_name",
        as_timestamp("shift_start").alias("shift_start"),
        as_timestamp("shift_end").alias("shift_end"),
        "crew_id", "supervisor_employee_id", "operator_employee_id", "handoff_notes",
    )


def work_order_people(work_orders_raw: DataFrame) -> DataFrame:
    """PII-01: one row per order, key ``work_order_id``."""
    return work_orders_raw.select(
        "work_order_id", "plant_id", "technician_employee_id", "technician_name",
        "technician_email", "technician_badge_id",
    )


def alarm_ack_people(alarms_raw: DataFrame) -> DataFrame:
    """PII-02: one row per alarm, key ``alarm_id``."""
    return alarms_raw.select("alarm_id", "plant_id", "acked_by_employee_id", "acked_by_name")


def shift_people(shifts_raw: DataFrame) -> DataFrame:
    """PII-03: one row per shift, key ``shift_id``."""
    return shifts_raw.select(
        "shift_id", "plant_id", "crew_id",
        "supervisor_employee_id", "supervisor_name", "supervisor_email", "supervisor_phone",
        "operator_employee_id", "operator_name", "operator_email", "operator_phone",
        "handoff_notes",
    )


SILVER_BUILDERS = {
    "assets": silver_assets,
    "work_orders": silver_work_orders,
    "alarms": silver_alarms,
    "production_events": silver_production_events,
    "shifts": silver_shifts,
}

PEOPLE_BUILDERS = {
    "work_order_people": ("work_orders", work_order_people),
    "alarm_ack_people": ("alarms", alarm_ack_people),
    "shift_people": ("shifts", shift_people),
}
