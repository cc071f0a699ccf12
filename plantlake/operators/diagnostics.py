"""Runbook diagnostics (DGN-01..04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def freshness(points_raw: DataFrame) -> DataFrame:
    """DGN-01: latest landing time and row count (one global aggregate)."""
    return points_raw.agg(F.max("ingest_ts").alias("last_ingest_ts"), F.count(F.lit(1)).alias("points"))


def latest_points(points_raw: DataFrame, n: int = 50) -> DataFrame:
    """DGN-02: the ``n`` latest points by landing time (top-k, ties by tag and time)."""
    return points_raw.orderBy(F.col("ingest_ts").desc(), F.col("event_ts").desc(), "tag_name", "value").limit(n)


def health_list(health: DataFrame, n: int = 50) -> DataFrame:
    """DGN-03: newest day first, lowest score first (top-k, ties by plant and asset)."""
    return health.orderBy(F.col("day_dt").desc(), F.col("health_score").asc(), "plant_id", "asset_id").limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """DGN-04: rows per table, with ``ok`` when at least one row."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("ok", F.col("rows") >= 1)
