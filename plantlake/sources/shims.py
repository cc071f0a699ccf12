"""Test-data shims: the driver's generated tables -> plant-shaped raw inputs.

The driver's tables (``events``, ``customer``, ``orders``, ``lineitem``,
``conversations``, ``documents``) are mapped to the six raw (bronze) inputs of
the pipeline.  Each mapping exists twice, once as Spark DataFrame code and
once as DuckDB SQL text (``ORACLE_SHIMS``) for the oracle; the operators
themselves never mention these tables.  Raw CSV-shaped frames hold STRING
columns, so the silver casts are exercised; a few planted values (``n/a``
labour hours, duplicate production-event ids, closed-before-opened orders,
names inside shift notes) exercise the quality checks and the redaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE_REDACT_NAMES
from ..sources.points import BRONZE_POINT_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SEC_FMT = "yyyy-MM-dd HH:mm:ss"
MICRO_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, from any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# Spark SQL text of the mappings: one ``selectExpr`` per frame keeps the
# driver's work (one expression parse instead of a round trip per column
# function) small.
_PEOPLE = "array(" + ", ".join(f"'{n}'" for n in REFERENCE_REDACT_NAMES) + ")"


def _person_sql(k: str) -> str:
    return f"element_at({_PEOPLE}, CAST(({k}) % {len(REFERENCE_REDACT_NAMES)} + 1 AS INT))"


def _email_sql(k: str) -> str:
    return f"concat(lower(translate({_person_sql(k)}, ' ', '.')), '@example.com')"


def _plant_sql(k: str) -> str:
    return f"concat('PLANT-0', CAST(({k}) % 3 + 1 AS STRING))"


_SFX_SQL = ("CASE event_type WHEN 'view' THEN 'Vibration' WHEN 'click' THEN 'BearingTemp' "
            "WHEN 'purchase' THEN 'MotorAmps' WHEN 'signup' THEN 'RunStatus' ELSE 'SuctionPressure' END")
_VAL_SQL = ("CASE WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CASE event_type WHEN 'view' THEN value / 40 WHEN 'click' THEN 55 + value / 10 "
            "WHEN 'purchase' THEN 40 + value / 20 WHEN 'signup' THEN CAST(event_id % 2 AS DOUBLE) "
            "ELSE value / 100 END END")
_UOM_SQL = ("CASE WHEN event_id % 109 = 0 THEN NULL ELSE CASE event_type WHEN 'view' THEN 'mm/s' WHEN 'click' "
            "THEN 'degC' WHEN 'purchase' THEN 'A' WHEN 'signup' THEN 'bool' ELSE 'bar' END END")
# Planted contract faults: no quality, an unknown quality, no unit, a value that is not a number.
_QUALITY_SQL = "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN 'Weird' WHEN event_id % 20 = 0 THEN 'Bad' WHEN event_id % 20 = 1 THEN 'Uncertain' ELSE 'Good' END"
_TAG_SQL = ("concat(chr(92), chr(92), 'PLANT-0', CAST(user_id % 3 + 1 AS STRING), chr(92), 'AST-', "
            f"CAST(user_id AS STRING), '|', {_SFX_SQL})")
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def points_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze points from ``events``: one reading per event."""
    base = read_table(spark, sf_dir, "events").selectExpr(
        f"{_TAG_SQL} AS tag_name",
        "concat('AST-', CAST(user_id AS STRING)) AS asset_id",
        "CAST(ts AS TIMESTAMP) AS event_ts",
        f"{_VAL_SQL} AS value",
        f"{_QUALITY_SQL} AS quality",
        f"{_UOM_SQL} AS uom",
        "'mock_pi' AS source_system",
        f"{_plant_sql('user_id')} AS plant_id",
        "concat('AREA-', CAST(user_id % 2 + 1 AS STRING)) AS area_id",
        "CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, event_id % 60) AS ingest_ts",
    )
    return base.selectExpr(
        "*", "to_json(named_struct('tag_name', tag_name, 'asset_id', asset_id, 'timestamp', "
        f"date_format(event_ts, \"{_ISO}\"), 'value', value, 'quality', quality, 'uom', uom, "
        "'source_system', source_system, 'plant_id', plant_id, 'area_id', area_id)) AS raw_payload",
    ).select(*BRONZE_POINT_COLUMNS)


def point_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as JSON-array messages, for stream tests.

    One message per (user, reading time), like one poll's snapshot: a message
    holds the readings taken at one instant, so its size does not grow with
    the table even when one user owns most of the events.
    """
    pts = read_table(spark, sf_dir, "events").selectExpr(
        "user_id AS _uid", "ts AS _ts", "date_trunc('HOUR', ts) AS _hour",
        f"named_struct('tag_name', {_TAG_SQL}, 'asset_id', concat('AST-', CAST(user_id AS STRING)), "
        f"'timestamp', date_format(ts, \"{_ISO}\"), 'value', {_VAL_SQL}, 'quality', {_QUALITY_SQL}, "
        f"'uom', {_UOM_SQL}, 'source_system', 'mock_pi', 'plant_id', {_plant_sql('user_id')}, "
        "'area_id', concat('AREA-', CAST(user_id % 2 + 1 AS STRING))) AS p")
    return pts.groupBy("_uid", "_ts", "_hour").agg(F.to_json(F.collect_list("p")).alias("value")).select(
        "_hour", "value")


BROKEN_SQL = "concat('[{\"tag_name\": \"broken-', CAST(event_id AS STRING))"


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut off in the middle, one for every 500th event."""
    return read_table(spark, sf_dir, "events").filter("event_id % 500 = 0").selectExpr(
        "date_trunc('HOUR', ts) AS _hour", f"{BROKEN_SQL} AS value")


def assets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        f"{_plant_sql('c_custkey')} AS plant_id",
        "concat('AREA-', CAST(c_custkey % 2 + 1 AS STRING)) AS area_id",
        "concat('UNIT-', CAST(c_nationkey AS STRING)) AS unit_id",
        "concat('AST-', CAST(c_custkey AS STRING)) AS asset_id",
        "c_name AS asset_name",
        "CASE c_custkey % 3 WHEN 0 THEN 'pump' WHEN 1 THEN 'compressor' ELSE 'fan' END AS asset_type",
        "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'A' WHEN c_mktsegment = 'MACHINERY' THEN 'B' "
        "ELSE 'C' END AS criticality",
        "concat('MFR-', CAST(c_nationkey % 5 AS STRING)) AS manufacturer",
        "date_format(date_add(DATE'2015-01-01', CAST(c_custkey % 3000 AS INT)), 'yyyy-MM-dd') AS install_date",
        "CASE WHEN c_custkey % 10 = 0 THEN concat('AST-', CAST(c_custkey + 1 AS STRING)) ELSE '' END "
        "AS parent_asset_id",
    )


def work_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    # pre-aggregate lineitem per order before the join (one row per order)
    last = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    # An order without lines has no closing time.  A row per order is no broadcast side, small as its files may be.
    j = o.join(last.hint("merge"), o.o_orderkey == last.l_orderkey, "left")
    return j.selectExpr(
        "concat('WO-', CAST(o_orderkey AS STRING)) AS work_order_id",
        "concat('AST-', CAST(o_custkey AS STRING)) AS asset_id",
        f"{_plant_sql('o_custkey')} AS plant_id",
        f"date_format(o_orderdate, '{SEC_FMT}') AS opened_at",
        f"CASE WHEN o_orderstatus = 'F' THEN date_format(last_ship, '{SEC_FMT}') END AS closed_at",
        "CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status",
        "CASE o_custkey % 5 WHEN 1 THEN 'BRG-WEAR' WHEN 2 THEN 'SEAL-LEAK' WHEN 3 THEN 'ALIGN' "
        "WHEN 4 THEN 'VIB-HIGH' END AS failure_code",
        "substring(o_orderpriority, 1, 1) AS priority",
        "concat('E', CAST(o_custkey % 40 + 10000 AS STRING)) AS technician_employee_id",
        f"{_person_sql('o_custkey')} AS technician_name",
        f"{_email_sql('o_custkey')} AS technician_email",
        "concat('BDG-', CAST(o_custkey % 40 + 4000 AS STRING)) AS technician_badge_id",
        "CASE WHEN o_orderkey % 3 <> 0 THEN concat('kit-', CAST(o_orderkey % 7 AS STRING)) END AS parts_used",
        "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 5 <> 0 "
        "THEN concat(CAST(o_orderkey % 17 AS STRING), '.5') END AS labor_hours",
        "concat('order ', CAST(o_orderkey AS STRING)) AS notes",
    )


_CODE_SQL = ("CASE event_id % 4 WHEN 0 THEN 'VIB_HI' WHEN 1 THEN 'TEMP_HI' WHEN 2 THEN 'SUCT_LO' "
             "ELSE 'AMP_SPIKE' END")


def alarms_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").filter(F.col("event_type") == "error").selectExpr(
        "concat('ALM-', CAST(event_id AS STRING)) AS alarm_id",
        "concat('AST-', CAST(user_id AS STRING)) AS asset_id",
        # some alarms carry the asset id of another plant's asset
        f"{_plant_sql('user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END')} AS plant_id",
        f"date_format(ts, '{MICRO_FMT}') AS raised_at",
        "CASE WHEN event_id % 7 <> 0 THEN date_format(ts + make_dt_interval(0, 0, CAST(floor(value) AS INT), 0), "
        f"'{MICRO_FMT}') END AS cleared_at",
        "CASE WHEN value >= 100 THEN 'HIGH' WHEN value >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS severity",
        f"{_CODE_SQL} AS alarm_code",
        f"concat('alarm ', {_CODE_SQL}) AS alarm_text",
        f"CASE WHEN event_id % 11 <> 0 THEN date_format(ts + make_dt_interval(0, 0, 2, 0), '{MICRO_FMT}') END "
        "AS acked_at",
        "CASE WHEN event_id % 11 <> 0 THEN concat('E', CAST(user_id % 40 + 10000 AS STRING)) END "
        "AS acked_by_employee_id",
        f"CASE WHEN event_id % 11 <> 0 THEN {_person_sql('user_id')} END AS acked_by_name",
    )


def production_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = "CAST(l_quantity AS BIGINT)"
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        "concat('PRD-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS event_id",
        f"{_plant_sql('l_suppkey')} AS plant_id",
        "concat('AREA-', CAST(l_suppkey % 2 + 1 AS STRING)) AS area_id",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'LINE-A' ELSE 'LINE-B' END AS line_id",
        "concat('AST-', CAST(l_suppkey AS STRING)) AS asset_id",
        f"date_format(l_shipdate, '{SEC_FMT}') AS event_start",
        f"date_format(l_shipdate + make_dt_interval(0, CAST({q} AS INT), 0, 0), '{SEC_FMT}') AS event_end",
        "CASE WHEN l_returnflag = 'R' THEN 'DOWNTIME' ELSE 'RUN' END AS event_type",
        "CASE WHEN l_returnflag = 'R' THEN 'UNPLANNED_MECH' END AS downtime_code",
        f"CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN '0' ELSE CAST({q} * 9 AS STRING) END "
        "AS good_count",
        f"CASE WHEN l_returnflag = 'R' THEN '0' ELSE CAST({q} % 3 AS STRING) END AS scrap_count",
        f"CAST({q} * 10 AS STRING) AS planned_count",
        "'line event' AS notes",
    )


def shifts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = "CAST(conv_id % 90 AS INT)"
    t0 = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    sup = (f"CASE conv_id % 20 WHEN 3 THEN 'Maria da Silva Santos' WHEN 7 THEN 'Jean-Luc Van Dam' "
           f"WHEN 11 THEN 'José Núñez' ELSE {_person_sql('conv_id')} END")
    op = _person_sql("conv_id + 3")
    return read_table(spark, sf_dir, "conversations").selectExpr(
        # planted: rows without an id, and one id for several rows
        "CASE WHEN conv_id % 50 = 9 THEN NULL WHEN conv_id % 50 = 10 THEN 'SH-SAME' "
        "ELSE concat('SH-', CAST(conv_id * 100 + turn AS STRING)) END AS shift_id",
        f"{_plant_sql('conv_id')} AS plant_id",
        "concat('AREA-', CAST(conv_id % 2 + 1 AS STRING)) AS area_id",
        f"CASE {slot} % 3 WHEN 0 THEN 'Night' WHEN 1 THEN 'Day' ELSE 'Evening' END AS shift_name",
        f"date_format({t0} + make_dt_interval(0, {slot} * 8, 0, 0), '{SEC_FMT}') AS shift_start",
        f"date_format({t0} + make_dt_interval(0, {slot} * 8 + 8, 0, 0), '{SEC_FMT}') AS shift_end",
        "concat('CREW-', CAST(conv_id % 4 + 1 AS STRING)) AS crew_id",
        "concat('E', CAST(conv_id % 8 + 20000 AS STRING)) AS supervisor_employee_id",
        f"{sup} AS supervisor_name",
        f"{_email_sql('conv_id')} AS supervisor_email",
        "concat('+1-555-01', lpad(CAST(conv_id % 100 AS STRING), 2, '0')) AS supervisor_phone",
        "concat('E', CAST((conv_id + 3) % 8 + 20010 AS STRING)) AS operator_employee_id",
        f"{op} AS operator_name",
        f"{_email_sql('conv_id + 3')} AS operator_email",
        "concat('+1-555-02', lpad(CAST(conv_id % 100 AS STRING), 2, '0')) AS operator_phone",
        f"CASE WHEN conv_id % 20 IN (3, 7, 11) THEN concat(text, ' Ask ', upper({sup}), ' now') "
        f"WHEN conv_id % 10 = 0 THEN concat(text, ' Ask ', upper({sup}), ' first.') "
        f"WHEN conv_id % 10 = 5 THEN concat(text, ' Call ', lower({op}), '.') ELSE text END AS handoff_notes",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


RAW_SHIMS = {
    "points_raw": points_raw,
    "assets_raw": assets_raw,
    "work_orders_raw": work_orders_raw,
    "alarms_raw": alarms_raw,
    "production_events_raw": production_events_raw,
    "shifts_raw": shifts_raw,
}


# ---------------------------------------------------------------------------
# The same mappings as DuckDB SQL (oracle side).  chr(92) is a backslash.
# ---------------------------------------------------------------------------

_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in REFERENCE_REDACT_NAMES) + "]"


def _pname(expr: str) -> str:
    return f"({_NAMES_SQL})[({expr}) % {len(REFERENCE_REDACT_NAMES)} + 1]"


def _pemail(expr: str) -> str:
    return f"lower(replace({_pname(expr)}, ' ', '.')) || '@example.com'"


_SFX = ("CASE event_type WHEN 'view' THEN 'Vibration' WHEN 'click' THEN 'BearingTemp' "
        "WHEN 'purchase' THEN 'MotorAmps' WHEN 'signup' THEN 'RunStatus' ELSE 'SuctionPressure' END")
_VAL = ("CASE WHEN event_id % 101 = 0 THEN 'NaN'::DOUBLE ELSE CASE event_type WHEN 'view' THEN value / 40 WHEN 'click' THEN 55 + value / 10 "
        "WHEN 'purchase' THEN 40 + value / 20 WHEN 'signup' THEN CAST(event_id % 2 AS DOUBLE) "
        "ELSE value / 100 END END")
_UOM = ("CASE WHEN event_id % 109 = 0 THEN NULL ELSE CASE event_type WHEN 'view' THEN 'mm/s' WHEN 'click' "
        "THEN 'degC' WHEN 'purchase' THEN 'A' WHEN 'signup' THEN 'bool' ELSE 'bar' END END")
_SUP = ("CASE conv_id % 20 WHEN 3 THEN 'Maria da Silva Santos' WHEN 7 THEN 'Jean-Luc Van Dam' "
        f"WHEN 11 THEN 'José Núñez' ELSE {_pname('conv_id')} END")
_SEC = "'%Y-%m-%d %H:%M:%S'"
_MICRO = "'%Y-%m-%d %H:%M:%S.%f'"

ORACLE_SHIMS = {
    "points_raw": f"""
SELECT concat(chr(92), chr(92), 'PLANT-0', CAST(user_id % 3 + 1 AS VARCHAR), chr(92), 'AST-',
              CAST(user_id AS VARCHAR), '|', {_SFX}) AS tag_name,
       'AST-' || CAST(user_id AS VARCHAR) AS asset_id,
       ts AS event_ts,
       {_VAL} AS value,
       CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN 'Weird' WHEN event_id % 20 = 0 THEN 'Bad'
            WHEN event_id % 20 = 1 THEN 'Uncertain' ELSE 'Good' END AS quality,
       {_UOM} AS uom,
       'mock_pi' AS source_system,
       'PLANT-0' || CAST(user_id % 3 + 1 AS VARCHAR) AS plant_id,
       'AREA-' || CAST(user_id % 2 + 1 AS VARCHAR) AS area_id,
       ts + to_seconds(CAST(event_id % 60 AS BIGINT)) AS ingest_ts
FROM events""",
    "assets_raw": """
SELECT 'PLANT-0' || CAST(c_custkey % 3 + 1 AS VARCHAR) AS plant_id,
       'AREA-' || CAST(c_custkey % 2 + 1 AS VARCHAR) AS area_id,
       'UNIT-' || CAST(c_nationkey AS VARCHAR) AS unit_id,
       'AST-' || CAST(c_custkey AS VARCHAR) AS asset_id,
       c_name AS asset_name,
       CASE c_custkey % 3 WHEN 0 THEN 'pump' WHEN 1 THEN 'compressor' ELSE 'fan' END AS asset_type,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'A' WHEN c_mktsegment = 'MACHINERY' THEN 'B' ELSE 'C' END AS criticality,
       'MFR-' || CAST(c_nationkey % 5 AS VARCHAR) AS manufacturer,
       strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y-%m-%d') AS install_date,
       CASE WHEN c_custkey % 10 = 0 THEN 'AST-' || CAST(c_custkey + 1 AS VARCHAR) ELSE '' END AS parent_asset_id
FROM customer""",
    "work_orders_raw": f"""
SELECT 'WO-' || CAST(o.o_orderkey AS VARCHAR) AS work_order_id,
       'AST-' || CAST(o.o_custkey AS VARCHAR) AS asset_id,
       'PLANT-0' || CAST(o.o_custkey % 3 + 1 AS VARCHAR) AS plant_id,
       strftime(o.o_orderdate, {_SEC}) AS opened_at,
       CASE WHEN o.o_orderstatus = 'F' THEN strftime(l.last_ship, {_SEC}) END AS closed_at,
       CASE WHEN o.o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status,
       CASE o.o_custkey % 5 WHEN 1 THEN 'BRG-WEAR' WHEN 2 THEN 'SEAL-LEAK' WHEN 3 THEN 'ALIGN' WHEN 4 THEN 'VIB-HIGH' END AS failure_code,
       substr(o.o_orderpriority, 1, 1) AS priority,
       'E' || CAST(o.o_custkey % 40 + 10000 AS VARCHAR) AS technician_employee_id,
       {_pname('o.o_custkey')} AS technician_name,
       {_pemail('o.o_custkey')} AS technician_email,
       'BDG-' || CAST(o.o_custkey % 40 + 4000 AS VARCHAR) AS technician_badge_id,
       CASE WHEN o.o_orderkey % 3 <> 0 THEN 'kit-' || CAST(o.o_orderkey % 7 AS VARCHAR) END AS parts_used,
       CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/a' WHEN o.o_orderkey % 5 <> 0 THEN CAST(o.o_orderkey % 17 AS VARCHAR) || '.5' END AS labor_hours,
       'order ' || CAST(o.o_orderkey AS VARCHAR) AS notes
FROM orders o
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey""",
    "alarms_raw": f"""
SELECT 'ALM-' || CAST(event_id AS VARCHAR) AS alarm_id,
       'AST-' || CAST(user_id AS VARCHAR) AS asset_id,
       'PLANT-0' || CAST((user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 3 + 1 AS VARCHAR) AS plant_id,
       strftime(ts, {_MICRO}) AS raised_at,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts + to_minutes(CAST(floor(value) AS BIGINT)), {_MICRO}) END AS cleared_at,
       CASE WHEN value >= 100 THEN 'HIGH' WHEN value >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CASE event_id % 4 WHEN 0 THEN 'VIB_HI' WHEN 1 THEN 'TEMP_HI' WHEN 2 THEN 'SUCT_LO' ELSE 'AMP_SPIKE' END AS alarm_code,
       'alarm ' || CASE event_id % 4 WHEN 0 THEN 'VIB_HI' WHEN 1 THEN 'TEMP_HI' WHEN 2 THEN 'SUCT_LO' ELSE 'AMP_SPIKE' END AS alarm_text,
       CASE WHEN event_id % 11 <> 0 THEN strftime(ts + to_minutes(2), {_MICRO}) END AS acked_at,
       CASE WHEN event_id % 11 <> 0 THEN 'E' || CAST(user_id % 40 + 10000 AS VARCHAR) END AS acked_by_employee_id,
       CASE WHEN event_id % 11 <> 0 THEN {_pname('user_id')} END AS acked_by_name
FROM events WHERE event_type = 'error'""",
    "production_events_raw": f"""
SELECT 'PRD-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
       'PLANT-0' || CAST(l_suppkey % 3 + 1 AS VARCHAR) AS plant_id,
       'AREA-' || CAST(l_suppkey % 2 + 1 AS VARCHAR) AS area_id,
       CASE WHEN l_suppkey % 2 = 0 THEN 'LINE-A' ELSE 'LINE-B' END AS line_id,
       'AST-' || CAST(l_suppkey AS VARCHAR) AS asset_id,
       strftime(l_shipdate, {_SEC}) AS event_start,
       strftime(l_shipdate + to_hours(CAST(l_quantity AS BIGINT)), {_SEC}) AS event_end,
       CASE WHEN l_returnflag = 'R' THEN 'DOWNTIME' ELSE 'RUN' END AS event_type,
       CASE WHEN l_returnflag = 'R' THEN 'UNPLANNED_MECH' END AS downtime_code,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN '0'
            ELSE CAST(CAST(l_quantity AS BIGINT) * 9 AS VARCHAR) END AS good_count,
       CASE WHEN l_returnflag = 'R' THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) % 3 AS VARCHAR) END AS scrap_count,
       CAST(CAST(l_quantity AS BIGINT) * 10 AS VARCHAR) AS planned_count,
       'line event' AS notes
FROM lineitem""",
    "shifts_raw": f"""
SELECT CASE WHEN conv_id % 50 = 9 THEN NULL WHEN conv_id % 50 = 10 THEN 'SH-SAME'
            ELSE 'SH-' || CAST(conv_id * 100 + turn AS VARCHAR) END AS shift_id,
       'PLANT-0' || CAST(conv_id % 3 + 1 AS VARCHAR) AS plant_id,
       'AREA-' || CAST(conv_id % 2 + 1 AS VARCHAR) AS area_id,
       CASE (conv_id % 90) % 3 WHEN 0 THEN 'Night' WHEN 1 THEN 'Day' ELSE 'Evening' END AS shift_name,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((conv_id % 90) * 8 AS BIGINT)), {_SEC}) AS shift_start,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((conv_id % 90) * 8 + 8 AS BIGINT)), {_SEC}) AS shift_end,
       'CREW-' || CAST(conv_id % 4 + 1 AS VARCHAR) AS crew_id,
       'E' || CAST(conv_id % 8 + 20000 AS VARCHAR) AS supervisor_employee_id,
       {_SUP} AS supervisor_name,
       {_pemail('conv_id')} AS supervisor_email,
       '+1-555-01' || lpad(CAST(conv_id % 100 AS VARCHAR), 2, '0') AS supervisor_phone,
       'E' || CAST((conv_id + 3) % 8 + 20010 AS VARCHAR) AS operator_employee_id,
       {_pname('conv_id + 3')} AS operator_name,
       {_pemail('conv_id + 3')} AS operator_email,
       '+1-555-02' || lpad(CAST(conv_id % 100 AS VARCHAR), 2, '0') AS operator_phone,
       CASE WHEN conv_id % 20 IN (3, 7, 11) THEN text || ' Ask ' || upper({_SUP}) || ' now'
            WHEN conv_id % 10 = 0 THEN text || ' Ask ' || upper({_pname('conv_id')}) || ' first.'
            WHEN conv_id % 10 = 5 THEN text || ' Call ' || lower({_pname('conv_id + 3')}) || '.'
            ELSE text END AS handoff_notes
FROM conversations""",
}
