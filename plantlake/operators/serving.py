"""Serving-safe views (SRV-01..08 and the production-event view of trap T17).

Every view lists its columns; none is ``SELECT *``, so a column added
upstream cannot leak through.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RECENT_DAYS, PERSON_TOKEN, REFERENCE_REDACT_NAMES
from ..functions import is_set, names_pattern, technician_role
from .metrics import as_of_ts

ASSET_COLUMNS = ("plant_id", "area_id", "unit_id", "asset_id", "asset_name", "asset_type",
                 "criticality", "manufacturer", "install_date", "parent_asset_id")
HEALTH_COLUMNS = ("plant_id", "asset_id", "asset_name", "criticality", "day_dt", "vib",
                  "bearing_temp", "motor_amps", "run_frac", "health_score", "anomaly_flag",
                  "signals_observed")
OEE_COLUMNS = ("plant_id", "area_id", "line_id", "day_dt", "run_hours", "down_hours", "good_count",
               "scrap_count", "planned_count", "quality_ratio", "availability_ratio")
OUTCOME_COLUMNS = ("work_order_id", "plant_id", "asset_id", "opened_at", "closed_at", "status",
                   "failure_code", "priority", "parts_used", "labor_hours", "mttr_hours")
POINT_COLUMNS = ("tag_name", "asset_id", "event_ts", "value", "quality", "uom", "plant_id",
                 "area_id", "tag_suffix")
EVENT_COLUMNS = ("event_id", "plant_id", "area_id", "line_id", "asset_id", "event_start", "event_end", "event_type",
                 "downtime_code", "good_count", "scrap_count", "planned_count")


def serving_work_orders(work_orders: DataFrame) -> DataFrame:
    """SRV-01: role proxy instead of the technician; no employee id, no notes."""
    return work_orders.select(
        "work_order_id", "asset_id", "plant_id", "opened_at", "closed_at", "status",
        "failure_code", "priority", technician_role("priority").alias("technician_role"),
        "parts_used", "labor_hours",
    )


def serving_alarms(alarms: DataFrame) -> DataFrame:
    """SRV-02: ``was_acked`` instead of the acknowledger."""
    return alarms.select(
        "alarm_id", "asset_id", "plant_id", "raised_at", "cleared_at", "severity", "alarm_code",
        "alarm_text", "acked_at", is_set("acked_by_employee_id").alias("was_acked"),
    )


def redact_names(df: DataFrame, text_col: str, names=REFERENCE_REDACT_NAMES,
                 out_col: str | None = None) -> DataFrame:
    """Replace person names in a text column by ``[PERSON]``.

    ``names`` as a list: one case-insensitive alternation, longest name first
    (the reference's form; it matches inside words too).  ``names`` as a
    DataFrame with a ``name`` column (a dictionary that grows with the
    workforce): the same replacement of whole words only, in any script, with
    names of any length.  Texts are told apart by their digest, so repeated
    or NULL row keys do not matter; a NULL text stays NULL.
    """
    out_col = out_col or text_col
    if isinstance(names, DataFrame):
        return _redact_by_table(df, text_col, names, out_col)
    return df.withColumn(out_col, F.regexp_replace(F.col(text_col), names_pattern(names), PERSON_TOKEN))


# Split at every word / non-word boundary: words and separators alternate.
_BOUNDARY = r"(?U)(?<=\W)(?=\w)|(?<=\w)(?=\W)"


def _tokens(text) -> Column:
    return F.split(F.lower(text), _BOUNDARY)


def _redact_by_table(df: DataFrame, text_col: str, names: DataFrame, out_col: str) -> DataFrame:
    """Each text's distinct token runs, of exactly the lengths that the dictionary has, are looked up in the
    dictionary; the few names found come back by the text's digest, and the text is rebuilt in its row by one
    pattern of its own names.  Only (digest, run) pairs are shuffled, never a text's tokens in order.

    The planner knows a table's files, not the rows that come of cutting its texts, so neither the runs nor the
    texts with names may be a broadcast side: the lookup is a semi join, which can only broadcast the dictionary,
    and the way back is a merge join."""
    bare = F.regexp_replace(F.lower(F.col("name")), r"(?U)^\W+|\W+$", "")
    dic = names.select(bare.alias("run")).filter("run != ''").distinct()
    sizes = dic.select(F.collect_set(F.size(F.split("run", _BOUNDARY))).alias("sizes")).scalar()
    texts = df.filter(F.col(text_col).isNotNull()).select(
        F.sha2(F.col(text_col), 256).alias("digest"), _tokens(F.col(text_col)).alias("tokens"),
        sizes.alias("sizes"))
    starts = texts.select("digest", "tokens", F.explode("sizes").alias("n"))
    runs = F.transform(F.sequence(F.lit(1), F.size("tokens") - F.col("n") + 1),
                       lambda i: F.array_join(F.slice(F.col("tokens"), i, F.col("n")), ""))
    found = starts.filter(F.col("n") <= F.size("tokens")).select(
        "digest", F.explode(F.array_distinct(runs)).alias("run")).join(dic, "run", "left_semi").groupBy("digest").agg(
        F.collect_set("run").alias("found"))
    # Longest name first, quoted; (?iuU): any case and Unicode words.
    longest = F.array_sort("found", lambda x, y: F.length(y) - F.length(x))
    quoted = F.transform(longest, lambda x: F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit(r"\E\\E\Q")),
                                                     F.lit(r"\E")))
    pattern = F.concat(F.lit(r"(?iuU)(?<!\w)(?:"), F.array_join(quoted, "|"), F.lit(r")(?!\w)"))
    found = found.select(F.col("digest").alias("_digest"), pattern.alias("_pattern"))
    out = df.join(found.hint("merge"), F.sha2(F.col(text_col), 256) == F.col("_digest"), "left")
    text = F.col(text_col)
    done = F.when(F.col("_pattern").isNull(), text).otherwise(
        F.regexp_replace(text, F.col("_pattern"), F.lit(PERSON_TOKEN)))
    return out.withColumn(out_col, done).drop("_digest", "_pattern")


def serving_shifts(shifts: DataFrame, names=REFERENCE_REDACT_NAMES) -> DataFrame:
    """SRV-03: shift header plus notes with names replaced."""
    red = redact_names(shifts, "handoff_notes", names, out_col="handoff_notes_redacted")
    return red.select("shift_id", "plant_id", "area_id", "shift_name", "shift_start", "shift_end",
                      "crew_id", "handoff_notes_redacted")


def serving_assets(assets: DataFrame) -> DataFrame:
    """SRV-04."""
    return assets.select(*ASSET_COLUMNS)


def serving_health(health: DataFrame) -> DataFrame:
    """SRV-05."""
    return health.select(*HEALTH_COLUMNS)


def serving_oee(oee: DataFrame) -> DataFrame:
    """SRV-06."""
    return oee.select(*OEE_COLUMNS)


def serving_outcomes(outcomes: DataFrame) -> DataFrame:
    """SRV-07."""
    return outcomes.select(*OUTCOME_COLUMNS)


def points_recent(points: DataFrame, days: int = DEFAULT_RECENT_DAYS, as_of=None) -> DataFrame:
    """SRV-08: points of the last ``days`` days (bounds folded to literals, pushed to the scan)."""
    hi = as_of_ts(as_of)
    lo = hi - F.expr(f"INTERVAL {int(days)} DAYS")
    cond = F.col("event_ts") >= lo
    if as_of is not None:
        cond = cond & (F.col("event_ts") <= hi)
    if "event_date" in points.columns:  # partition pruning on the date column
        cond = cond & (F.col("event_date") >= F.to_date(lo))
    return points.filter(cond).select(*POINT_COLUMNS)


def serving_production_events(events: DataFrame) -> DataFrame:
    """Production events without free-text notes (trap T17, for TOOL-08)."""
    return events.select(*EVENT_COLUMNS)


def names_from_people(*people: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """Name dictionary (column ``name``) from the people tables' name columns."""
    frames = []
    for df in people:
        for c in df.columns:
            if c.endswith("_name") and (not columns or c in columns):
                frames.append(df.select(F.col(c).alias("name")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.filter(F.col("name").isNotNull()).distinct()
