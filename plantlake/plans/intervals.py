"""Overlapping intervals: union lengths, merged intervals and overlap reports, per key.

Intervals are half-open.  Each is cut at midnight, so a window sorts the
pieces of one key and day, never all of a hot key's intervals.  In a key's day
a running maximum of the ends seen so far tells how much of a piece is new;
union lengths add up over days.  Merged intervals (islands) are built per day,
and only those that touch midnight, two per key and day at most, are stitched
across days.  Rows without a start, an end behind it, or a key are no intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DAY = 86_400_000_000  # microseconds


def day_pieces(df: DataFrame, keys: list[str], start: str, end: str, *extra: Column) -> DataFrame:
    """(keys, extra, day, lo, hi, first): microseconds of every day's part of every interval."""
    lo, hi = F.unix_micros(F.col(start)), F.unix_micros(F.col(end))
    whole = df.filter(F.col(end) > F.col(start)).filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    whole = whole.select(*keys, *extra, lo.alias("s"), hi.alias("e"))
    cut = whole.withColumn("day", F.explode(F.sequence(F.floor(F.col("s") / _DAY), F.floor((F.col("e") - 1) / _DAY))))
    return cut.withColumn("lo", F.greatest(F.col("s"), F.col("day") * _DAY)) \
        .withColumn("hi", F.least(F.col("e"), (F.col("day") + 1) * _DAY)) \
        .withColumn("first", F.col("lo") == F.col("s")).drop("s", "e")


def new_time(keys: list[str], lo: str = "lo", hi: str = "hi") -> Column:
    """Microseconds of a piece that no earlier piece of its key and day covers."""
    before = Window.partitionBy(*keys, "day").orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max(hi).over(before), F.col(lo))
    return F.greatest(F.col(hi) - F.greatest(F.col(lo), covered), F.lit(0))


def _islands(pieces: DataFrame, group: list[str]) -> DataFrame:
    """Pieces of a group merged where they meet or overlap: (group, lo, hi, n)."""
    ordered = Window.partitionBy(*group).orderBy("lo", "hi")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.max("hi").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.select(
        *group, "lo", "hi", "n", F.coalesce(F.col("lo") > before, F.lit(True)).alias("_opens"),
        F.max("hi").over(upto).alias("_reached"), F.lead("lo").over(ordered).alias("_next"), F.sum("n").over(upto).alias("_n"))
    # An island ends where the next piece starts behind all before it.  Its start, and the count before it, are those
    # of the last opening, the largest so far.  One sort serves all windows, and nothing is aggregated.
    last = lambda c: F.max(F.when(F.col("_opens"), c)).over(upto)
    ends = F.coalesce(F.col("_next") > F.col("_reached"), F.lit(True))
    return marked.select(
        *group, last(F.col("lo")).alias("_lo"), "_reached", (F.col("_n") - last(F.col("_n") - F.col("n"))).alias("_n"),
        ends.alias("_ends")).filter("_ends").select(
        *group, F.col("_lo").alias("lo"), F.col("_reached").alias("hi"), F.col("_n").alias("n"))


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, ``start``, ``end``, n_intervals): the intervals of a key merged where they overlap or touch.

    ``n_intervals`` counts the input rows in each."""
    pieces = day_pieces(df, keys, start, end).withColumn("n", F.col("first").cast("bigint"))
    daily = _islands(pieces, [*keys, "day"])
    day = F.col("day") * _DAY
    touches = (F.col("lo") == day) | (F.col("hi") == day + _DAY)
    inner = daily.filter(~touches).select(*keys, "lo", "hi", "n")
    stitched = _islands(daily.filter(touches), keys).select(*keys, "lo", "hi", "n")
    return inner.unionByName(stitched).select(
        *keys, F.timestamp_micros("lo").alias(start), F.timestamp_micros("hi").alias(end),
        F.col("n").alias("n_intervals"))


def overlap_check(df: DataFrame, table: str, keys: list[str], start: str, end: str) -> DataFrame:
    """DQ-04: keys' days on which intervals overlap, and the seconds that are counted more than once."""
    pieces = day_pieces(df, keys, start, end)
    daily = pieces.withColumn("new", new_time(keys)).groupBy(*keys, "day").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("summed"), F.sum("new").alias("covered"))
    return daily.agg(
        F.count(F.lit(1)).alias("key_days"), F.count_if(F.col("summed") > F.col("covered")).alias("overlapping_days"),
        (F.coalesce(F.sum("covered"), F.lit(0)) / 1e6).alias("covered_seconds"),
        (F.coalesce(F.sum(F.col("summed") - F.col("covered")), F.lit(0)) / 1e6).alias("overlap_seconds"),
    ).select(F.lit(table).alias("table_name"), "key_days", "overlapping_days", "covered_seconds", "overlap_seconds")


def hours_once(events: DataFrame, line: list[str]) -> DataFrame:
    """(line, day_dt, run_hours, down_hours): every instant of a line's day counts once, as down where a DOWNTIME
    event covers it, else as run where a RUN event does."""
    pieces = day_pieces(events.filter(F.col("event_type").isin("RUN", "DOWNTIME")), line, "event_start", "event_end",
                        (F.col("event_type") == "DOWNTIME").alias("down"))
    # One sort per line and day serves both: over all pieces, and over the DOWNTIME ones alone.
    before = Window.partitionBy(*line, "day").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    down_hi = F.max(F.when(F.col("down"), F.col("hi"))).over(before)
    new_down = F.greatest(F.col("hi") - F.greatest(F.col("lo"), F.coalesce(down_hi, F.col("lo"))), F.lit(0))
    daily = pieces.withColumn("any", new_time(line)).withColumn(
        "down_only", F.when(F.col("down"), new_down).otherwise(F.lit(0))).groupBy(*line, "day").agg(
        F.sum("any").alias("any"), F.sum("down_only").alias("down"))
    return daily.select(
        *line, F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")).alias("day_dt"),
        ((F.col("any") - F.col("down")) / 3.6e9).alias("run_hours"), (F.col("down") / 3.6e9).alias("down_hours"))
