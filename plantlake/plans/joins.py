"""The bucketed interval (range) join.

Equi-joins elsewhere are plain joins: whether a side is broadcast is decided
by bytes, by Spark's planner and again by AQE with the real shuffle sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Bucket indices count whole units since 1970.  The top block level spans
# Spark's whole timestamp range (years 1..9999) on both sides of 1970, so
# every bucket index lies in [-2^K, 2^K) and the top level has at most the
# two blocks -1 and 0.
UNIT_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}
RANGE_SECONDS = 8031 * 366 * 86400  # 1970 -> 10000, more than 1970 -> 0001


def levels(unit: str) -> int:
    """Top block level ``K``: ``2^K`` buckets of ``unit`` exceed the timestamp range."""
    return max(1, math.ceil(math.log2(RANGE_SECONDS / UNIT_SECONDS[unit])))


def bucket_sql(expr: str, unit: str = "HOUR") -> str:
    """SQL: whole ``unit`` buckets since 1970 (floor, exact integer arithmetic), BIGINT."""
    u = UNIT_SECONDS[unit] * 1_000_000
    return f"((unix_micros({expr}) - pmod(unix_micros({expr}), {u}L)) div {u}L)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cover_levels_sql(k: int) -> str:
    """SQL for the levels 0..L worth examining for the range ``[_a, _b]`` (NULL when empty).

    Blocks above level log2(_b - _a + 1) cannot lie inside the range; one
    level of margin absorbs rounding of log2, the tests below stay exact.
    """
    return (f"CASE WHEN _a <= _b THEN sequence(0, least({k}, CAST(floor(log2(_b - _a + 1)) AS INT) + 1)) END")


def cover_nodes_sql(k: int, level: str = "_l") -> tuple[str, str]:
    """SQL for the (at most two) cover blocks of ``[_a, _b]`` at level ``level``; NULL = none.

    Block ``(l, n)`` holds buckets ``[n * 2^l, (n + 1) * 2^l - 1]``.  The
    canonical cover takes a block when it lies inside ``[_a, _b]`` and its
    parent does not (top level: when it lies inside); it partitions the
    range.  Per level only the first inside block ``lo`` and the last ``hi``
    can qualify: ``lo`` does when it is odd (its parent reaches left of the
    range) or the only one, ``hi`` when it is even (its parent reaches right
    of the range).
    """
    lo = f"shiftright(_a + shiftleft(1L, {level}) - 1, {level})"
    hi = f"(shiftright(_b + 1, {level}) - 1)"
    left = f"CASE WHEN {lo} <= {hi} AND ({level} = {k} OR {lo} & 1 = 1 OR {lo} = {hi}) THEN {lo} END"
    right = f"CASE WHEN {lo} < {hi} AND ({level} = {k} OR {hi} & 1 = 0) THEN {hi} END"
    return left, right


def interval_join(windows: DataFrame, events: DataFrame, keys: list[str],
                  win_start: str, win_end: str, ev_start: str, ev_end: str | None = None,
                  bucketed: bool = True, unit: str = "HOUR") -> DataFrame:
    """Range join: pairs of a window and an event on the same keys whose times meet.

    ``ev_end`` None means point events; an event end of NULL means "still
    open".  Overlap is closed on both sides.  Column names of the two sides
    must not clash apart from ``keys`` (the key columns are taken from the
    window side).

    With ``bucketed`` every overlapping pair is found exactly once, by one
    equi-join on (keys, level, node), in one of two disjoint ways:

    * the event starts inside the window (``ws <= s``).  A window of ``n``
      ``unit`` buckets has the size class ``c = ceil(log2 n)`` and lies in at
      most two blocks of ``2^c`` buckets; an event has one row per size class
      that some window has (one, when all windows are equally long);
    * the event started before the window and is still on at its start
      (``s < ws <= e``, or open): the event's bucket range, up to the last
      window start, is cut into its canonical power-of-two blocks
      (``O(log span)`` rows), and the window carries, per level that the
      longest such range can use, the one block holding its start bucket.
      Exactly one block of the cover holds that bucket.

    The size classes, the last window start and the longest range are scalar
    subqueries, so a window of any length has two rows plus one per level.
    Each candidate pair shares a block of about the window's size or one that
    lies inside the event, so no key's windows are paired with all of its
    events, and a hot key spreads over its blocks (AQE splits what is still
    skewed).  Nothing is capped.
    """
    es, ws, we = _q(ev_start), _q(win_start), _q(win_end)
    ee = _q(ev_end) if ev_end else es
    overlap = f"{es} <= {we} AND ({ee} IS NULL OR {ee} >= {ws})"
    if not bucketed:
        return windows.join(events, keys, "inner").filter(overlap)
    wb, eb = stab_sides(windows, events, win_start, win_end, ev_start, ev_end, unit)
    case = f"CASE WHEN _lvl < 0 THEN {es} >= {ws} ELSE {es} < {ws} END"
    return wb.join(eb, keys + ["_lvl", "_node"], "inner").filter(f"{overlap} AND {case}").drop("_lvl", "_node")


def stab_sides(windows: DataFrame, events: DataFrame, win_start: str, win_end: str, ev_start: str,
               ev_end: str | None = None, unit: str = "HOUR") -> tuple[DataFrame, DataFrame]:
    """Both sides of :func:`interval_join` keyed by ``(_lvl, _node)``: level ``-1 - c`` = size class ``c``.

    Written as SQL text, one projection per step, so that building the plan
    costs the driver a few parses rather than a call per column function.
    """
    es, ws, we = _q(ev_start), _q(win_start), _q(win_end)
    k = levels(unit)
    b = lambda e: bucket_sql(e, unit)
    none = "CAST(array() AS array<struct<_lvl:int,_node:bigint>>)"
    w_cols, e_cols = [_q(c) for c in windows.columns], [_q(c) for c in events.columns]
    w = windows.selectExpr("*", f"{b(f'least({ws}, {we})')} AS _wa", f"{b(f'greatest({ws}, {we})')} AS _wb")
    w = w.selectExpr("*", "CAST(ceil(log2(_wb - _wa + 1)) AS INT) AS _c", f"{b(ws)} AS _ws")
    classes = w.selectExpr("array_sort(collect_set(_c))").scalar()
    e = events.withColumn("_classes", classes).selectExpr("*", f"{b(es)} AS _a")
    inside = "transform(sequence(shiftright(_wa, _c), shiftright(_wb, _c)), n -> named_struct('_lvl', -1 - _c, '_node', n))"
    at_start = "transform(_classes, c -> named_struct('_lvl', -1 - c, '_node', shiftright(_a, c)))"
    if not ev_end:
        return (w.selectExpr(*w_cols, f"inline({inside})"), e.selectExpr(*e_cols, f"inline({at_start})"))
    e = e.withColumn("_last", w.selectExpr("max(_ws)").scalar()) \
        .selectExpr("*", f"least(coalesce({b(_q(ev_end))}, _last), _last) AS _b")
    top = events.withColumn("_last", w.selectExpr("max(_ws)").scalar()).selectExpr(
        f"{b(es)} AS _a", f"least(coalesce({b(_q(ev_end))}, _last), _last) AS _b").filter("_a <= _b") \
        .selectExpr(f"max(least({k}, CAST(floor(log2(_b - _a + 1)) AS INT) + 1))").scalar()
    w = w.withColumn("_top", top)
    carried = ("transform(CASE WHEN _top IS NOT NULL THEN sequence(0, _top) ELSE CAST(array() AS array<int>) END, "
               "l -> named_struct('_lvl', l, '_node', shiftright(_ws, l)))")
    wb = w.selectExpr(*w_cols, f"inline(concat(coalesce({inside}, {none}), {carried}))")
    # One row per event and block: its start in every size class, then its cover (two blocks per level at most).
    left, right = cover_nodes_sql(k)
    starts = e.selectExpr(*e_cols, "_a", "_b", f"inline({at_start})").selectExpr(*e_cols, "_lvl", "_node")
    cover = e.selectExpr(*e_cols, "_a", "_b", f"explode({cover_levels_sql(k)}) AS _l").selectExpr(
        *e_cols, "_l AS _lvl", f"explode(array({left}, {right})) AS _node").filter("_node IS NOT NULL")
    return wb, starts.union(cover)
