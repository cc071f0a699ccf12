"""Fixed schemas (SNK-05).  Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# One point as it travels in JSON (the ``timestamp`` text is parsed in bronze).
POINT_SCHEMA = StructType([
    StructField("tag_name", StringType()),
    StructField("asset_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("value", DoubleType()),
    StructField("quality", StringType()),
    StructField("uom", StringType()),
    StructField("source_system", StringType()),
    StructField("plant_id", StringType()),
    StructField("area_id", StringType()),
])

# One message (a poll result or a bus message) is a JSON array of points.
POINT_BATCH_SCHEMA = ArrayType(POINT_SCHEMA)

POINTS_RAW_SCHEMA = StructType([
    StructField("tag_name", StringType()),
    StructField("asset_id", StringType()),
    StructField("event_ts", TimestampType()),
    StructField("value", DoubleType()),
    StructField("quality", StringType()),
    StructField("uom", StringType()),
    StructField("source_system", StringType()),
    StructField("plant_id", StringType()),
    StructField("area_id", StringType()),
    StructField("ingest_ts", TimestampType()),
    StructField("raw_payload", StringType()),
])

# Enrichment CSVs: every column lands as STRING (header order = file order).
CSV_COLUMNS = {
    "assets": (
        "plant_id", "area_id", "unit_id", "asset_id", "asset_name", "asset_type",
        "criticality", "manufacturer", "install_date", "parent_asset_id",
    ),
    "work_orders": (
        "work_order_id", "asset_id", "plant_id", "opened_at", "closed_at", "status",
        "failure_code", "priority", "technician_employee_id", "technician_name",
        "technician_email", "technician_badge_id", "parts_used", "labor_hours", "notes",
    ),
    "alarms": (
        "alarm_id", "asset_id", "plant_id", "raised_at", "cleared_at", "severity",
        "alarm_code", "alarm_text", "acked_at", "acked_by_employee_id", "acked_by_name",
    ),
    "production_events": (
        "event_id", "plant_id", "area_id", "line_id", "asset_id", "event_start",
        "event_end", "event_type", "downtime_code", "good_count", "scrap_count",
        "planned_count", "notes",
    ),
    "shifts": (
        "shift_id", "plant_id", "area_id", "shift_name", "shift_start", "shift_end",
        "crew_id", "supervisor_employee_id", "supervisor_name", "supervisor_email",
        "supervisor_phone", "operator_employee_id", "operator_name", "operator_email",
        "operator_phone", "handoff_notes",
    ),
}

CSV_SCHEMAS = {name: StructType(_strings(*cols)) for name, cols in CSV_COLUMNS.items()}

# Raw (bronze) tables add the landing stamp and the file name.
RAW_SCHEMAS = {
    name: StructType(list(schema.fields) + [
        StructField("ingest_ts", TimestampType()),
        StructField("source_file", StringType()),
    ])
    for name, schema in CSV_SCHEMAS.items()
}

# File name -> (raw table, CSV header) for the five enrichment files (SRC-02).
ENRICHMENT_FILES = {
    "assets.csv": "assets_raw",
    "work_orders.csv": "work_orders_raw",
    "alarms.csv": "alarms_raw",
    "production_events.csv": "production_events_raw",
    "shifts.csv": "shifts_raw",
}

TAG_DIM_SCHEMA = StructType([
    StructField("tag_suffix", StringType()),
    StructField("uom", StringType()),
    StructField("description", StringType()),
    StructField("nominal", DoubleType()),
    StructField("noise_pct", DoubleType()),
    StructField("drift_per_hour", DoubleType()),
])

# Databases of the medallion layout (SNK-06).
DATABASES = ("bronze", "silver", "ops_pii_restricted", "gold", "metrics", "serving_safe")
