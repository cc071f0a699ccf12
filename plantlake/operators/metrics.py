"""Metric views (MET-01..04) as functions returning DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RECENT_DAYS
from ..functions import safe_ratio


def as_of_ts(as_of) -> Column:
    """``as_of`` as a TIMESTAMP literal; None means the current time (T8)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        return F.lit(as_of).cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def as_of_date(as_of) -> Column:
    return F.current_date() if as_of is None else as_of_ts(as_of).cast("date")


def day_window(day_col: str, days: int, as_of) -> Column:
    """``day >= as_of_date - days`` (inclusive, as the reference), and no day after ``as_of``."""
    lo = F.date_sub(as_of_date(as_of), days)
    cond = F.col(day_col) >= lo
    if as_of is not None:
        cond = cond & (F.col(day_col) <= as_of_date(as_of))
    return cond


def asset_health_score(health: DataFrame) -> DataFrame:
    """MET-01: projection of the daily health table."""
    return health.select(
        "plant_id", "asset_id", "asset_name", "criticality", "day_dt", "health_score",
        "anomaly_flag", F.col("vib").alias("vibration_avg"), "bearing_temp", "motor_amps",
    )


def anomaly_rate(health: DataFrame, days: int = DEFAULT_RECENT_DAYS, as_of=None) -> DataFrame:
    """MET-02: share of flagged days per asset over the last ``days`` days."""
    flagged = F.count_if(F.col("anomaly_flag"))
    return (
        health.filter(day_window("day_dt", days, as_of))
        .groupBy("plant_id", "asset_id")
        .agg(flagged.alias("anomaly_days"), F.count(F.lit(1)).alias("days_observed"))
        .withColumn("anomaly_rate_7d", safe_ratio(F.col("anomaly_days"), F.col("days_observed")))
    )


def mtbf_proxy(outcomes: DataFrame) -> DataFrame:
    """MET-03: closed orders with a failure code: count and mean repair hours."""
    return (
        outcomes.filter((F.col("status") == "CLOSED") & F.col("failure_code").isNotNull())
        .groupBy("plant_id", "asset_id")
        .agg(F.count(F.lit(1)).alias("closed_failure_wos"), F.avg("mttr_hours").alias("avg_mttr_hours"))
    )


def oee_by_line(oee: DataFrame) -> DataFrame:
    """MET-04: availability x quality (quality NULL counts as 1.0)."""
    return oee.select(
        "plant_id", "area_id", "line_id", "day_dt", "availability_ratio", "quality_ratio",
        (F.col("availability_ratio") * F.coalesce(F.col("quality_ratio"), F.lit(1.0))).alias("oee_proxy"),
    )
