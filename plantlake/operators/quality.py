"""Data-quality checks (DQ-01..04).  Each is one pass of built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import QUALITIES, SOURCE_SYSTEMS

REQUIRED_POINT_FIELDS = ("tag_name", "asset_id", "event_ts", "value", "uom")


def reject_reason(required=REQUIRED_POINT_FIELDS) -> F.Column:
    """First failing rule of the point contract, NULL when the point is valid."""
    chain = None
    for c in required:
        cond = F.col(c).isNull()
        chain = F.when(cond, F.lit(f"missing_{c}")) if chain is None else chain.when(cond, F.lit(f"missing_{c}"))
    chain = chain.when(F.isnan("value") | (F.abs("value") == float("inf")), F.lit("value_not_finite"))
    chain = chain.when(F.col("quality").isNotNull() & ~F.col("quality").isin(list(QUALITIES)), F.lit("bad_quality_enum"))
    chain = chain.when(F.col("source_system").isNotNull() & ~F.col("source_system").isin(list(SOURCE_SYSTEMS)),
                       F.lit("bad_source_enum"))
    return chain


def check_contract(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DQ-01: split points into (good, quarantine with ``reject_reason``); no value is rewritten.

    A missing quality or source system is not a rejection; silver drops a
    missing quality by its own rule.
    """
    tagged = points.withColumn("reject_reason", reject_reason())
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = tagged.filter(F.col("reject_reason").isNotNull())
    return good, bad


def contract_summary(points: DataFrame) -> DataFrame:
    """DQ-01 as counts: rows per reason (``ok`` for valid rows)."""
    return points.groupBy(F.coalesce(reject_reason(), F.lit("ok")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("rows"))


# Casts per raw table: column -> target type (DQ-02).
CASTS = {
    "assets": {"install_date": "date"},
    "work_orders": {"opened_at": "timestamp", "closed_at": "timestamp", "priority": "int", "labor_hours": "double"},
    "alarms": {"raised_at": "timestamp", "cleared_at": "timestamp", "acked_at": "timestamp"},
    "production_events": {"event_start": "timestamp", "event_end": "timestamp", "good_count": "bigint",
                          "scrap_count": "bigint", "planned_count": "bigint"},
    "shifts": {"shift_start": "timestamp", "shift_end": "timestamp"},
}


def _cast_failed(c: str, t: str) -> F.Column:
    v = F.nullif(F.col(c), F.lit(""))
    return v.isNotNull() & v.try_cast(t).isNull()


def cast_quarantine(raw: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """DQ-02: (rows whose casts all succeed, rows with ``bad_columns``)."""
    bad_cols = F.array_compact(F.array(*[F.when(_cast_failed(c, t), F.lit(c)) for c, t in casts.items()]))
    tagged = raw.withColumn("bad_columns", bad_cols)
    return (tagged.filter(F.size("bad_columns") == 0).drop("bad_columns"),
            tagged.filter(F.size("bad_columns") > 0))


def cast_failures(raw: DataFrame, table: str, casts: dict[str, str]) -> DataFrame:
    """DQ-02 counts: one row per (table, column) with the number of failed casts."""
    wide = raw.agg(*[F.count_if(_cast_failed(c, t)).alias(c) for c, t in casts.items()])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failed_rows"))
                                  for c in casts]))
    return wide.select(stacked.alias("x")).select(F.lit(table).alias("table_name"), "x.column_name", "x.failed_rows")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-03: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_summary(df: DataFrame, table: str, keys: list[str], assets: DataFrame | None = None) -> DataFrame:
    """DQ-03 as one row: duplicate keys, rows in them, and rows whose asset is unknown."""
    dup = duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    nul = F.lit(None).cast("bigint")
    parts = dup.select("duplicate_keys", "duplicate_rows", nul.alias("orphan_rows"))
    if assets is not None:
        orphans = orphan_rows(df, assets).agg(F.count(F.lit(1)).alias("orphan_rows"))
        parts = parts.unionByName(orphans.select(nul.alias("duplicate_keys"), nul.alias("duplicate_rows"), "orphan_rows"))
    return parts.agg(
        F.max("duplicate_keys").alias("duplicate_keys"), F.max("duplicate_rows").alias("duplicate_rows"),
        F.coalesce(F.max("orphan_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
    ).select(F.lit(table).alias("table_name"), "duplicate_keys", "duplicate_rows", "orphan_rows")


def orphan_rows(df: DataFrame, assets: DataFrame) -> DataFrame:
    """DQ-03: rows whose (asset_id, plant_id) is not in the asset table."""
    return df.join(assets.select("asset_id", "plant_id"), ["asset_id", "plant_id"], "left_anti")


def interval_check(df: DataFrame, table: str, start: str, end: str) -> DataFrame:
    """DQ-04: rows with ``end < start`` and rows with an open end."""
    return df.agg(
        F.count_if(F.col(end) < F.col(start)).alias("end_before_start"),
        F.count_if(F.col(end).isNull()).alias("open_end"),
        F.count(F.lit(1)).alias("rows"),
    ).select(F.lit(table).alias("table_name"), "end_before_start", "open_end", "rows")
