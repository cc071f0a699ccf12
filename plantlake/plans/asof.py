"""As-of join: for each row the last row of another table at or before its time, per key.

Time is cut into buckets.  Level 1 is a window over each (key, bucket): the
rows of both sides in time order, and the last right row carried along.  Level
2 is a window over each key's buckets, of which there is one row each, made by
a partial aggregate: the last right row of all earlier buckets.  Its result
enters level 1 as the bucket's first row, so both levels meet in one window
and no join is needed.  A hot key is spread over its buckets; what is sorted
for it as a whole is one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "1 day"


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str,
              columns: dict[str, str], bucket: str = BUCKET, tolerance: str | None = None) -> DataFrame:
    """``left`` with ``columns`` (new name -> column of ``right``) of the last right row whose ``right_ts`` is not
    after ``left_ts``, where the ``on`` columns are equal.

    No left row is lost or repeated; without a match (also: a null key or time, or a match older than
    ``tolerance``) the new columns are null.  Of right rows at the same time the greatest (columns in the given
    order, nulls first) counts.  Right rows without a key or a time match nothing.
    """
    clash = {c.lower() for c in columns} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"left has columns of these names: {sorted(clash)}")
    keys = [f"k{i}" for i in range(len(on))]
    # An epoch count of buckets works for instants of any date and needs no calendar.
    width = f"CAST(unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {bucket}) AS BIGINT)"
    at = lambda c: F.floor(F.unix_micros(c) / F.expr(width)).cast("bigint")
    complete = lambda df, ts: df.filter(
        " AND ".join(f"`{c}` IS NOT NULL" for c in (*on, ts)))
    value = F.struct(F.col(right_ts).cast("timestamp").alias("ts"), F.struct(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns.values())]).alias("v"))
    key_of = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)]
    packed = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    none_left, none_right = F.lit(None).cast(left.select(packed).schema[0].dataType), F.lit(None).cast(
        right.select(value).schema[0].dataType)

    rights = complete(right, right_ts).select(*key_of, value.alias("r")).withColumn("b", at(F.col("r.ts")))
    lefts = complete(left, left_ts).select(*key_of, F.col(left_ts).cast("timestamp").alias("ts"), packed.alias("l"))
    lefts = lefts.withColumn("b", at(F.col("ts")))
    # Level 2: one row per key and bucket; a bucket without left rows is only carried over.
    buckets = rights.select(*keys, "b", F.lit(False).alias("asked"), "r").unionByName(
        lefts.select(*keys, "b", F.lit(True).alias("asked"), none_right.alias("r"))) \
        .groupBy(*keys, "b").agg(F.bool_or("asked").alias("asked"), F.max("r").alias("r"))
    earlier = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("r", F.last("r", ignorenulls=True).over(earlier)).filter("asked AND r IS NOT NULL")
    # Level 1: carried rows first, then by time, right rows before left ones of the same time.
    row = lambda df, ts, side, l: df.select(*keys, "b", ts.alias("ts"), F.lit(side).alias("side"),
                                            "r", l.alias("l"))
    rows = row(carried, F.lit(None).cast("timestamp"), 0, none_left) \
        .unionByName(row(rights, F.col("r.ts"), 1, none_left)) \
        .unionByName(row(lefts.withColumn("r", none_right), F.col("ts"), 2, F.col("l")))
    upto = Window.partitionBy(*keys, "b").orderBy(F.col("ts").asc_nulls_first(), "side", F.col("r.v")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("r", F.last("r", ignorenulls=True).over(upto)).filter("side = 2")
    young: Column = F.lit(True)
    if tolerance:
        young = F.col("r.ts") >= F.col("ts") - F.expr(f"INTERVAL {tolerance}")
    names = list(columns)
    matched = found.select("l.*", *[F.when(young, F.col(f"r.v.c{i}")).alias(n) for i, n in enumerate(names)])
    types = {n: matched.schema[n].dataType for n in names}
    unmatched = left.filter(" OR ".join(f"`{c}` IS NULL" for c in (*on, left_ts)))
    return matched.unionByName(unmatched.select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.lit(None).cast(types[n]).alias(n) for n in names]))
