"""Gold facts (GLD-01..05).

Plan shapes, as checked with ``explain``:

* ``tag_hourly``: partial HashAggregate -> Exchange hash(5 keys) -> final.
  A busy asset is absorbed by the map-side partial aggregate (its rows
  collapse to one row per hour and tag before the shuffle).
* ``health_daily``: a second aggregate by (plant, asset, day) over the hourly
  rows, then the asset dimension joined by a size-checked broadcast.
  ``prepartition=True`` hash-partitions points by (plant, asset) first, so
  both aggregates reuse one exchange.  It shuffles raw points before the
  partial aggregate, so it is only for data without a hot asset; the
  default shuffles pre-aggregated rows only (benchmarked both ways).
* ``oee_daily``: one aggregate; the RUN duration sum is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HealthRule
from ..functions import anomaly_flag, health_score, hours_between, safe_ratio, seconds_between
from ..plans.intervals import hours_once


def tag_hourly(points: DataFrame, only_running: bool = False, prepartition: bool = False) -> DataFrame:
    """GLD-01: per plant, area, asset, suffix and hour: avg, max, min, stddev, count.

    ``only_running`` drops readings of an asset taken while its RunStatus
    reading at the same instant is 0 (trap T5; off by default).
    """
    if only_running:
        from pyspark.sql import Window
        w = Window.partitionBy("plant_id", "asset_id", "event_ts")
        run = F.max(F.when(F.col("tag_suffix") == "RunStatus", F.col("value"))).over(w)
        points = points.withColumn("_run", run).filter(F.col("_run").isNull() | (F.col("_run") != 0)).drop("_run")
    if prepartition:
        points = points.repartition("plant_id", "asset_id")
    return (
        points.groupBy(
            "plant_id", "area_id", "asset_id", "tag_suffix",
            F.date_trunc("HOUR", F.col("event_ts")).alias("hour_ts"),
        ).agg(
            F.avg("value").alias("avg_value"),
            F.max("value").alias("max_value"),
            F.min("value").alias("min_value"),
            F.stddev_samp("value").alias("std_value"),
            F.count(F.lit(1)).alias("sample_count"),
        )
    )


def health_pivot(hourly: DataFrame, rule: HealthRule = HealthRule()) -> DataFrame:
    """GLD-02: daily signals = max of hourly averages per suffix (trap T4).

    A conditional ``max`` per signal, not ``.pivot``: one aggregate, no extra
    pass to find the pivot values.  ``signals_observed`` counts how many of
    vibration, temperature and amps were seen (trap T2).
    """
    sig = lambda suffix: F.max(F.when(F.col("tag_suffix") == suffix, F.col("avg_value")))
    return (
        hourly.groupBy("plant_id", "asset_id", F.col("hour_ts").cast("date").alias("day_dt"))
        .agg(
            sig(rule.vib_suffix).alias("vib"),
            sig(rule.temp_suffix).alias("bearing_temp"),
            sig(rule.amps_suffix).alias("motor_amps"),
            sig(rule.run_suffix).alias("run_frac"),
        )
        .withColumn(
            "signals_observed",
            (F.col("vib").isNotNull().cast("int") + F.col("bearing_temp").isNotNull().cast("int")
             + F.col("motor_amps").isNotNull().cast("int")),
        )
    )


def health_daily(hourly: DataFrame, assets: DataFrame, rule: HealthRule = HealthRule()) -> DataFrame:
    """GLD-03: daily pivot left-joined to assets, then score and flag."""
    pivot = health_pivot(hourly, rule)
    dim = assets.select("asset_id", "plant_id", "asset_name", "criticality")
    joined = pivot.join(dim, ["asset_id", "plant_id"], "left")
    return joined.select(
        "plant_id", "asset_id", "asset_name", "criticality", "day_dt",
        "vib", "bearing_temp", "motor_amps", "run_frac",
        health_score(F.col("vib"), F.col("bearing_temp"), F.col("motor_amps"), rule).alias("health_score"),
        anomaly_flag(F.col("vib"), F.col("bearing_temp"), rule).alias("anomaly_flag"),
        "signals_observed",
    )


def maintenance_outcomes(work_orders: DataFrame) -> DataFrame:
    """GLD-04: order columns plus repair time in hours when closed (may be < 0, T20)."""
    return work_orders.select(
        "work_order_id", "plant_id", "asset_id", "opened_at", "closed_at", "status",
        "failure_code", "priority", "parts_used", "labor_hours",
        F.when(F.col("closed_at").isNotNull(), hours_between("opened_at", "closed_at")).alias("mttr_hours"),
    )


def _split_at_midnight(events: DataFrame) -> DataFrame:
    """One piece per calendar day an event covers; counts stay on the first piece."""
    day0 = F.to_date("event_start")
    last = F.to_date(F.col("event_end") - F.expr("INTERVAL 1 MICROSECOND"))
    days = F.when(F.col("event_end") > F.col("event_start"),
                  F.sequence(day0, last, F.expr("INTERVAL 1 DAY"))).otherwise(F.array(day0))
    pieces = events.withColumn("_day", F.explode(days))
    nxt = F.col("_day").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    first = F.col("_day") == day0
    return pieces.select(
        *[c for c in events.columns if c not in ("event_start", "event_end", "good_count", "scrap_count", "planned_count")],
        F.greatest(F.col("event_start"), F.col("_day").cast("timestamp")).alias("event_start"),
        F.when(F.col("event_end").isNotNull(), F.least(F.col("event_end"), nxt)).alias("event_end"),
        F.when(first, F.col("good_count")).alias("good_count"),
        F.when(first, F.col("scrap_count")).alias("scrap_count"),
        F.when(first, F.col("planned_count")).alias("planned_count"),
    )


LINE = ("plant_id", "area_id", "line_id")


def oee_once(production_events: DataFrame) -> DataFrame:
    """GLD-05 where events overlap: every instant of a line counts once, on its own day.

    ``run_hours`` and ``down_hours`` are union lengths (an instant that is both
    is down); counts stay with an event's start day.  Columns as ``oee_daily``;
    a day that only has hours has zero counts.
    """
    hours = hours_once(production_events, list(LINE))
    counts = production_events.select(
        *LINE, F.col("event_start").cast("date").alias("day_dt"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good_count", "scrap_count", "planned_count")])
    both = counts.unionByName(hours, allowMissingColumns=True).groupBy(*LINE, "day_dt").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("run_hours", "down_hours")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good_count", "scrap_count", "planned_count")])
    return both.select(
        "*", safe_ratio(F.col("good_count"), F.col("planned_count")).alias("quality_ratio"),
        safe_ratio(F.col("run_hours"), F.col("run_hours") + F.col("down_hours")).alias("availability_ratio"))


def oee_daily(production_events: DataFrame, split_midnight: bool = False) -> DataFrame:
    """GLD-05: per plant, area, line and start day: hours, counts, ratios.

    An event across midnight counts wholly for its start day (trap T9) unless
    ``split_midnight``; overlapping events are summed (:func:`oee_once` counts
    an instant once).  Ratios are DOUBLE and NULL on a zero divisor;
    ``quality_ratio`` is good / planned (trap T6).
    """
    ev = _split_at_midnight(production_events) if split_midnight else production_events
    dur = seconds_between("event_start", "event_end")
    run_s = F.sum(F.when(F.col("event_type") == "RUN", dur).otherwise(F.lit(0)))
    down_s = F.sum(F.when(F.col("event_type") == "DOWNTIME", dur).otherwise(F.lit(0)))
    agg = ev.groupBy(
        "plant_id", "area_id", "line_id", F.col("event_start").cast("date").alias("day_dt"),
    ).agg(
        run_s.alias("_run_s"),
        down_s.alias("_down_s"),
        F.sum(F.coalesce("good_count", F.lit(0))).alias("good_count"),
        F.sum(F.coalesce("scrap_count", F.lit(0))).alias("scrap_count"),
        F.sum(F.coalesce("planned_count", F.lit(0))).alias("planned_count"),
    )
    return agg.select(
        "plant_id", "area_id", "line_id", "day_dt",
        (F.col("_run_s").cast("double") / 3600.0).alias("run_hours"),
        (F.col("_down_s").cast("double") / 3600.0).alias("down_hours"),
        "good_count", "scrap_count", "planned_count",
        safe_ratio(F.col("good_count"), F.col("planned_count")).alias("quality_ratio"),
        safe_ratio(F.col("_run_s"), F.col("_run_s") + F.col("_down_s")).alias("availability_ratio"),
    )
