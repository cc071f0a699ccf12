"""Consumer tools (TOOL-01..23): parameterised queries over serving and metrics.

Every tool takes its contract's inputs plus ``as_of`` (None = now) and
returns a DataFrame.  An ``asset_id`` or ``plant_id`` of None means every
asset or plant, so one job answers the question for the whole fleet (the
scheduled form of many agent calls).  Evidence whose size grows with the
data (an asset's open orders, a window's alarms, a plant's items for a
shift) is returned in long form, one row per item, with counts from partial
aggregates; no list is built over a group that one hot asset can fill.  The
only list kept is a window's rising tags, bounded by the asset's tag
catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_WINDOW_HOURS, TAG_SPECS, RcaRule
from ..functions import overlaps, safe_ratio
from ..plans.asof import asof_join
from ..plans.intervals import merged_intervals
from ..plans.joins import interval_join
from ..schemas import TAG_DIM_SCHEMA
from .metrics import anomaly_rate, as_of_date, as_of_ts, mtbf_proxy


def _ts(value) -> Column:
    return as_of_ts(value)


def _opt(df: DataFrame, **eq) -> DataFrame:
    for c, v in eq.items():
        if v is not None:
            df = df.filter(F.col(c) == F.lit(v))
    return df


def latest_health(health_metric: DataFrame) -> DataFrame:
    """Latest day per (plant, asset), ties impossible: day is part of the key."""
    w = Window.partitionBy("plant_id", "asset_id").orderBy(F.col("day_dt").desc())
    return health_metric.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# -- maintenance advisor ------------------------------------------------------

def list_unhealthy_assets(health_metric: DataFrame, plant_id: str | None, min_health: float = 70.0) -> DataFrame:
    """TOOL-01: latest day per asset with ``health_score < min_health``, worst first."""
    latest = latest_health(_opt(health_metric, plant_id=plant_id))
    return latest.filter(F.col("health_score") < F.lit(float(min_health))).orderBy("health_score", "asset_id")


def get_asset_health(health: DataFrame, asset_id: str | None = None, days: int = 7, as_of=None) -> DataFrame:
    """TOOL-02: an asset's (None: every asset's) daily health over ``days`` days up to ``as_of``."""
    d = as_of_date(as_of)
    out = _opt(health, asset_id=asset_id).filter((F.col("day_dt") >= F.date_sub(d, days)) & (F.col("day_dt") <= d))
    return out.orderBy("day_dt") if asset_id is not None else out


def list_open_work_orders(work_orders: DataFrame, asset_id: str | None = None, plant_id: str | None = None) -> DataFrame:
    """TOOL-03: status OPEN, optional asset and plant."""
    return _opt(work_orders.filter(F.col("status") == "OPEN"), asset_id=asset_id, plant_id=plant_id)


def get_anomaly_rate(health: DataFrame, asset_id: str | None = None, days: int = 7, as_of=None) -> DataFrame:
    """TOOL-04: MET-02 for an asset (the asset filter is pushed below the aggregate)."""
    return anomaly_rate(_opt(health, asset_id=asset_id), days, as_of)


def get_mtbf_proxy(outcomes: DataFrame, asset_id: str | None = None) -> DataFrame:
    """TOOL-05: MET-03 for an asset."""
    return mtbf_proxy(_opt(outcomes, asset_id=asset_id))


# -- RCA ---------------------------------------------------------------------

def get_alarms_in_window(alarms: DataFrame, asset_id: str | None, start, end) -> DataFrame:
    """TOOL-06: alarms of an asset whose active interval meets ``[start, end]``."""
    return _opt(alarms, asset_id=asset_id).filter(overlaps("raised_at", "cleared_at", _ts(start), _ts(end)))


def get_tag_series(points_recent: DataFrame, asset_id: str | None, tag_suffix: str, start, end) -> DataFrame:
    """TOOL-07: one tag's readings in ``[start, end]``; in time order for a single asset."""
    out = _opt(points_recent, asset_id=asset_id).filter(
        (F.col("tag_suffix") == tag_suffix) & F.col("event_ts").between(_ts(start), _ts(end)))
    return out.orderBy("event_ts") if asset_id is not None else out


def get_downtime_events(production_events: DataFrame, asset_id: str | None, start, end) -> DataFrame:
    """TOOL-08: DOWNTIME events of an asset that meet ``[start, end]``."""
    return _opt(production_events, asset_id=asset_id).filter(
        (F.col("event_type") == "DOWNTIME") & overlaps("event_start", "event_end", _ts(start), _ts(end)))


def downtime_islands(production_events: DataFrame, asset_id: str | None = None) -> DataFrame:
    """TOOL-08, merged: an asset's downtime without double counting, overlapping or touching events as one."""
    down = _opt(production_events, asset_id=asset_id).filter(F.col("event_type") == "DOWNTIME")
    return merged_intervals(down, ["plant_id", "asset_id"], "event_start", "event_end")


def get_recent_failures(outcomes: DataFrame, asset_id: str | None = None, n: int = 10) -> DataFrame:
    """TOOL-09: each asset's ``n`` latest orders with a failure code (a top-k report).

    For one asset this is a global top-k (``TakeOrderedAndProject``).  For
    every asset it is ``row_number() <= n`` per asset, which Spark plans with
    a partial ``WindowGroupLimit`` before the shuffle: each map task forwards
    at most ``n`` rows per asset, so a hot asset's task sorts
    ``n * map tasks`` rows, not all of its orders.
    """
    failed = _opt(outcomes, asset_id=asset_id).filter(F.col("failure_code").isNotNull())
    order = (F.col("opened_at").desc(), F.col("work_order_id"))
    if asset_id is not None:
        return failed.orderBy(*order).limit(n)
    w = Window.partitionBy("plant_id", "asset_id").orderBy(*order)
    return failed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# -- shift briefing -----------------------------------------------------------

def get_shift_context(shifts: DataFrame, plant_id: str, area_id: str | None, as_of=None) -> DataFrame:
    """TOOL-10: shifts containing ``as_of``; half-open ``[start, end)`` because shifts touch."""
    t = _ts(as_of)
    return _opt(shifts, plant_id=plant_id, area_id=area_id).filter(
        (F.col("shift_start") <= t) & (t < F.col("shift_end")))


def alarm_context(alarms: DataFrame, points: DataFrame, shifts: DataFrame, assets: DataFrame,
                  tag_suffix: str = "Vibration", tolerance: str | None = None) -> DataFrame:
    """TOOL-07, TOOL-10 for many instants at once: each alarm with the asset's last reading of ``tag_suffix`` and the
    crew on duty in the asset's area when it was raised.

    Both are as-of joins: the last reading, and the last shift start, not after the alarm.  A crew whose shift has
    ended by then (half-open, as in TOOL-10) is none.
    """
    area = assets.groupBy("plant_id", "asset_id").agg(F.min("area_id").alias("area_id"))
    raised = alarms.select("alarm_id", "plant_id", "asset_id", "raised_at").join(area, ["plant_id", "asset_id"], "left")
    readings = points.filter(F.col("tag_suffix") == tag_suffix)
    read = asof_join(raised, readings, ["plant_id", "asset_id"], "raised_at", "event_ts",
                     {"last_value": "value", "last_value_ts": "event_ts"}, tolerance=tolerance)
    manned = asof_join(read, shifts, ["plant_id", "area_id"], "raised_at", "shift_start",
                       {"crew_id": "crew_id", "shift_name": "shift_name", "_until": "shift_end"})
    on_duty = F.col("raised_at") < F.col("_until")
    return manned.select("alarm_id", "plant_id", "asset_id", "area_id", "raised_at", "last_value", "last_value_ts",
                         *[F.when(on_duty, F.col(c)).alias(c) for c in ("crew_id", "shift_name")])


def list_overnight_anomalies(health: DataFrame, alarms: DataFrame, plant_id: str | None,
                             hours: int = DEFAULT_WINDOW_HOURS, as_of=None) -> DataFrame:
    """TOOL-11: flagged health days and alarms meeting the last ``hours`` hours.

    One row per item: ``(plant_id, asset_id, source, signal, ts)``.
    """
    hi = _ts(as_of)
    lo = hi - F.expr(f"INTERVAL {int(hours)} HOURS")
    flagged = _opt(health, plant_id=plant_id).filter(
        F.col("anomaly_flag") & (F.col("day_dt") >= lo.cast("date")) & (F.col("day_dt") <= hi.cast("date"))
    ).select("plant_id", "asset_id", F.lit("health").alias("source"),
             F.lit("ANOMALY_FLAG").alias("signal"), F.col("day_dt").cast("timestamp").alias("ts"))
    alarmed = _opt(alarms, plant_id=plant_id).filter(overlaps("raised_at", "cleared_at", lo, hi)).select(
        "plant_id", "asset_id", F.lit("alarm").alias("source"), F.col("alarm_code").alias("signal"),
        F.col("raised_at").alias("ts"))
    return flagged.unionByName(alarmed)


def list_open_high_priority_wos(work_orders: DataFrame, plant_id: str | None, max_priority: int = 1) -> DataFrame:
    """TOOL-12: OPEN and priority <= 1 (the on-call band)."""
    return _opt(work_orders, plant_id=plant_id).filter(
        (F.col("status") == "OPEN") & (F.col("priority") <= max_priority))


def list_active_alarms(alarms: DataFrame, plant_id: str | None) -> DataFrame:
    """TOOL-13: alarms not yet cleared."""
    return _opt(alarms, plant_id=plant_id).filter(F.col("cleared_at").isNull())


# -- composites ----------------------------------------------------------------

def advisor_evidence(health_metric: DataFrame, work_orders: DataFrame, plant_id: str | None = None,
                     min_health: float = 70.0) -> DataFrame:
    """TOOL-14: latest health per asset with its open orders, in long form.

    One row per (asset, open order), or one row with ``open_wo`` NULL for an
    asset without open orders; ``n_open_wos`` and ``inspect`` (score below
    ``min_health`` or flagged) repeat the asset's values.  The count is a
    partial aggregate.  Orders meet their asset in an inner join, in which
    AQE can split the side that one hot asset fills (a left join from the
    asset could not be split there); assets without open orders are added.
    """
    keys = ["plant_id", "asset_id"]
    latest = latest_health(_opt(health_metric, plant_id=plant_id))
    open_wos = _opt(work_orders, plant_id=plant_id).filter(F.col("status") == "OPEN").select(
        *keys, F.col("work_order_id").alias("open_wo"))
    counts = open_wos.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_open_wos"))
    n = F.coalesce(F.col("n_open_wos"), F.lit(0))
    head = latest.join(counts, keys, "left").select(
        *keys, "day_dt", "health_score", "anomaly_flag", n.alias("n_open_wos"),
        ((F.col("health_score") < F.lit(float(min_health))) | F.col("anomaly_flag")).alias("inspect"))
    with_order = open_wos.join(head, keys).select(*head.columns, "open_wo")
    return with_order.unionByName(head.filter("n_open_wos = 0").withColumn("open_wo", F.lit(None).cast("string")))


def incident_windows(alarms: DataFrame, before_hours: int = 2, after_hours: int = 2,
                     severities=("HIGH", "MEDIUM")) -> DataFrame:
    """Incident windows around raised alarms: ``[raised - before, raised + after]``."""
    return alarms.filter(F.col("severity").isin(list(severities))).select(
        F.col("alarm_id").alias("window_id"), "asset_id", "plant_id",
        (F.col("raised_at") - F.expr(f"INTERVAL {int(before_hours)} HOURS")).alias("win_start"),
        (F.col("raised_at") + F.expr(f"INTERVAL {int(after_hours)} HOURS")).alias("win_end"),
    )


_RCA_KEYS = ["asset_id", "plant_id"]


def _kw(rule: RcaRule, bucketed: bool) -> dict:
    return dict(bucketed=bucketed, unit=rule.interval_bucket)


def rca_alarms(windows: DataFrame, alarms: DataFrame, rule: RcaRule = RcaRule(), bucketed: bool = True) -> DataFrame:
    """TOOL-15 alarm evidence in long form: one row per (window, alarm meeting it)."""
    win = windows.select("window_id", *_RCA_KEYS, "win_start", "win_end")
    al = alarms.select(*_RCA_KEYS, "alarm_id", "raised_at", "cleared_at")
    return interval_join(win, al, _RCA_KEYS, "win_start", "win_end", "raised_at", "cleared_at",
                         **_kw(rule, bucketed)).select("window_id", "alarm_id")


def rca_evidence(windows: DataFrame, alarms: DataFrame, points: DataFrame, production_events: DataFrame,
                 outcomes: DataFrame, rule: RcaRule = RcaRule(), bucketed: bool = True) -> DataFrame:
    """TOOL-15: evidence summary for many incident windows at once.

    Per window: the number of alarms meeting it (their ids are
    :func:`rca_alarms`, in long form, because a hot asset can fill a window
    with any number of alarms), the tags that rose inside it (positive
    least-squares slope and last - first > ``min_delta``; a list bounded by
    the asset's tags), downtime meeting it (count and hours clipped to the
    window), and the modal failure code of the asset (an asset id belongs to its plant everywhere) (ties: latest order, then
    code).  Alarms and downtime meet the windows in one stabbing join (one
    window side for both), points in the bucket join.  The evidence is
    unioned and aggregated once per window (one shuffle), then joined back
    to the windows.
    """
    win = windows.select("window_id", *_RCA_KEYS, "win_start", "win_end")
    nul = lambda t: F.lit(None).cast(t)

    # alarms and downtime meet the windows in one stabbing join (_k: a = alarm, d = downtime)
    al = alarms.selectExpr(*_RCA_KEYS, "'a' AS _k", "alarm_id AS _id", "raised_at AS _s", "cleared_at AS _e")
    dt = production_events.filter(F.col("event_type") == "DOWNTIME").selectExpr(
        *_RCA_KEYS, "'d' AS _k", "CAST(NULL AS STRING) AS _id", "event_start AS _s", "event_end AS _e")
    iv_rows = interval_join(win, al.unionByName(dt), _RCA_KEYS, "win_start", "win_end", "_s", "_e",
                            **_kw(rule, bucketed)).selectExpr(
        "window_id", "CASE WHEN _k = 'a' THEN _id END AS alarm_id", "CAST(NULL AS STRING) AS tag_suffix",
        "CASE WHEN _k = 'd' THEN unix_timestamp(least(coalesce(_e, win_end), win_end)) "
        "- unix_timestamp(greatest(_s, win_start)) END AS dt_secs",
        "_k = 'a' AS _is_alarm")

    pts = points.select(*_RCA_KEYS, "tag_suffix", "event_ts", "value")
    p_pairs = interval_join(win, pts, _RCA_KEYS, "win_start", "win_end", "event_ts", bucketed=bucketed,
                            unit=rule.bucket)
    t = F.unix_micros("event_ts").cast("double") / F.lit(1e6)
    at = F.struct("event_ts", "value")  # readings of one instant are told apart by their value
    per_tag = p_pairs.groupBy("window_id", "tag_suffix").agg(
        F.regr_slope(F.col("value"), t).alias("slope"),
        (F.max_by("value", at) - F.min_by("value", at)).alias("delta"),
        F.count(F.lit(1)).alias("n"))
    tag_rows = per_tag.filter((F.col("n") >= rule.min_points) & (F.col("slope") > 0)
                              & (F.col("delta") > F.lit(rule.min_delta))).select(
        "window_id", nul("string").alias("alarm_id"), "tag_suffix", nul("bigint").alias("dt_secs"),
        F.lit(False).alias("_is_alarm"))

    evidence = iv_rows.unionByName(tag_rows).groupBy("window_id").agg(
        F.count_if("_is_alarm").alias("n_alarms"),
        F.array_join(F.sort_array(F.collect_list("tag_suffix")), ",").alias("rising_tags"),
        F.count("dt_secs").alias("n_downtime"),
        (F.sum("dt_secs").cast("double") / 3600.0).alias("downtime_hours"))

    codes = (outcomes.filter(F.col("failure_code").isNotNull())
             .groupBy(*_RCA_KEYS, "failure_code")
             .agg(F.count(F.lit(1)).alias("_n"), F.max("opened_at").alias("_last")))
    wc = Window.partitionBy(*_RCA_KEYS).orderBy(F.col("_n").desc(), F.col("_last").desc(), F.col("failure_code"))
    modal = codes.withColumn("_rn", F.row_number().over(wc)).filter("_rn = 1").select(
        *_RCA_KEYS, F.col("failure_code").alias("likely_failure_code"))

    # ``modal`` is an aggregate (one row per asset): AQE broadcasts it when its
    # real shuffle size is small, else keeps the sort-merge join and splits a
    # hot asset's windows (skew join).  A bounded pre-check would compute it twice.
    out = windows.join(evidence, "window_id", "left").join(modal, _RCA_KEYS, "left")
    return out.select(
        "window_id", "asset_id", "plant_id", "win_start", "win_end",
        F.coalesce("n_alarms", F.lit(0)).alias("n_alarms"),
        F.coalesce("rising_tags", F.lit("")).alias("rising_tags"),
        F.coalesce("n_downtime", F.lit(0)).alias("n_downtime"),
        F.coalesce("downtime_hours", F.lit(0.0)).alias("downtime_hours"),
        "likely_failure_code",
    )


def shift_brief(shifts: DataFrame, health: DataFrame, alarms: DataFrame, work_orders: DataFrame,
                assets: DataFrame, plant_id: str | None = None, area_id: str | None = None, hours: int = 12,
                as_of=None, max_priority: int = 1) -> DataFrame:
    """TOOL-16: brief for the crews on shift at ``as_of``, in long form.

    Items stand once per (plant, area) that has a crew on duty: ``anomaly``
    (TOOL-11 over the ``hours`` before ``as_of``), ``active_alarm``
    (TOOL-13) and ``open_priority_wo`` (TOOL-12).  An item's area is its
    asset's; items of unknown assets have no area and no brief.  Each shift
    adds one ``notes`` row (the redacted notes) with its crew, and reads the
    items of its plant and area: shifts and items are never multiplied.
    """
    ctx = get_shift_context(shifts, plant_id, area_id, as_of)
    notes = ctx.select("plant_id", "area_id", "shift_id", "crew_id", F.lit("notes").alias("item_type"),
                       F.lit(None).cast("string").alias("asset_id"), F.col("handoff_notes_redacted").alias("item"))
    typed = lambda df, kind, item: df.select(
        "plant_id", "asset_id", F.lit(kind).alias("item_type"), F.col(item).alias("item"))
    found = typed(list_overnight_anomalies(health, alarms, plant_id, hours, as_of), "anomaly", "signal") \
        .unionByName(typed(list_active_alarms(alarms, plant_id), "active_alarm", "alarm_id")) \
        .unionByName(typed(list_open_high_priority_wos(work_orders, plant_id, max_priority), "open_priority_wo",
                           "work_order_id"))
    on_duty = ctx.select("plant_id", "area_id").distinct()
    placed = assets.select("plant_id", "asset_id", "area_id").join(on_duty, ["plant_id", "area_id"], "left_semi")
    nul = F.lit(None).cast("string")
    items = found.join(placed, ["plant_id", "asset_id"]).select(
        "plant_id", "area_id", nul.alias("shift_id"), nul.alias("crew_id"), "item_type", "asset_id", "item")
    return items.unionByName(notes)


def health_trend(health: DataFrame, asset_id: str | None = None, days: int = 7, as_of=None) -> DataFrame:
    """TOOL-17: daily score, change from the previous day and the window's slope per day.

    The window functions partition by asset over at most ``days + 1`` daily
    rows, so no partition grows with the data.
    """
    h = get_asset_health(health, asset_id, days, as_of)
    w = Window.partitionBy("plant_id", "asset_id").orderBy("day_dt")
    whole = Window.partitionBy("plant_id", "asset_id")
    x = F.datediff(F.col("day_dt"), F.lit("1970-01-01").cast("date")).cast("double")
    return h.select(
        "plant_id", "asset_id", "day_dt", "health_score",
        (F.col("health_score") - F.lag("health_score").over(w)).alias("delta_prev"),
        F.regr_slope(F.col("health_score"), x).over(whole).alias("trend_slope"),
    )


def flagged_today(health: DataFrame, as_of=None) -> DataFrame:
    """TOOL-18: assets flagged on the ``as_of`` day."""
    return health.filter(F.col("anomaly_flag") & (F.col("day_dt") == as_of_date(as_of)))


def critical_open_orders(work_orders: DataFrame, assets: DataFrame, criticality: str = "A") -> DataFrame:
    """TOOL-19: open orders of assets of a criticality (semi join on asset and plant)."""
    crit = assets.filter(F.col("criticality") == criticality).select("asset_id", "plant_id")
    return work_orders.filter(F.col("status") == "OPEN").join(crit, ["asset_id", "plant_id"], "left_semi")


def compare_lines(oee: DataFrame, lines=None) -> DataFrame:
    """TOOL-20: per line, the mean of daily OEE and the OEE of summed hours and counts."""
    src = oee if lines is None else oee.filter(F.col("line_id").isin(list(lines)))
    daily_oee = F.col("availability_ratio") * F.coalesce(F.col("quality_ratio"), F.lit(1.0))
    g = src.groupBy("plant_id", "line_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(daily_oee).alias("mean_daily_oee"),
        F.sum("run_hours").alias("_run"), F.sum("down_hours").alias("_down"),
        F.sum("good_count").alias("_good"), F.sum("planned_count").alias("_planned"))
    avail = safe_ratio(F.col("_run"), F.col("_run") + F.col("_down"))
    qual = F.coalesce(safe_ratio(F.col("_good"), F.col("_planned")), F.lit(1.0))
    return g.select("plant_id", "line_id", "days", "mean_daily_oee", (avail * qual).alias("pooled_oee"))


def high_alarms(alarms: DataFrame, severity: str = "HIGH") -> DataFrame:
    """TOOL-21: uncleared alarms of a severity."""
    return alarms.filter((F.col("severity") == severity) & F.col("cleared_at").isNull())


def tag_dimension(spark: SparkSession) -> DataFrame:
    """Tag catalogue by suffix (fixed 7 rows, safe to broadcast)."""
    return spark.createDataFrame([tuple(r) for r in TAG_SPECS], TAG_DIM_SCHEMA)


def nominal_deviation(hourly: DataFrame, tags: DataFrame) -> DataFrame:
    """TOOL-22: hourly average against the nominal of its tag, and outside the noise band."""
    dim = F.broadcast(tags.select("tag_suffix", "nominal", "noise_pct"))
    j = hourly.join(dim, "tag_suffix", "inner")
    dev = F.when(F.col("nominal") != 0, (F.col("avg_value") - F.col("nominal")) / F.col("nominal"))
    return j.select(
        "plant_id", "area_id", "asset_id", "tag_suffix", "hour_ts", "avg_value", "nominal",
        dev.alias("deviation_pct"),
        F.coalesce(F.abs(dev) > F.col("noise_pct"), F.lit(False)).alias("outside_band"))


def ingest_status(points_raw: DataFrame) -> DataFrame:
    """TOOL-23: assets, tags per asset and points in the raw table.

    One partial aggregate by (asset, tag) first: the raw points collapse on
    the map side to one row per pair, and the two distinct counts run over
    that small result (no ``Expand`` that doubles every raw row).
    """
    pairs = points_raw.groupBy("asset_id", "tag_name").agg(F.count(F.lit(1)).alias("_n"))
    g = pairs.agg(F.count_distinct("asset_id").alias("assets"),
                  F.count_distinct("tag_name").alias("_tags"), F.sum("_n").cast("bigint").alias("points"))
    return g.select("assets", (F.col("_tags") / F.greatest(F.col("assets"), F.lit(1))).cast("bigint").alias("tags_per_asset"),
                    "points")

