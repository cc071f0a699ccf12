"""Incremental daily gold: micro-batches that rebuild only the dates they touch (STR-06).

``foreachBatch`` may see a batch twice (a restart between the write and the
commit of its offsets), and late rows belong to dates that are long written.
So each batch

1. writes its silver rows to a folder of its own (``silver/batch=<id>``,
   overwritten on a replay),
2. takes the dates it touches, and rebuilds their hourly statistics, daily
   health or daily line figures from all silver rows of these dates, with
   duplicates between batches dropped,
3. replaces exactly these dates (dynamic partition overwrite), and
4. writes its row in the ledger, the sign that it is done; a batch whose row
   is there is skipped.

Every step gives the same result when it is repeated.  The work of a batch is
its dates' rows, not the table; silver folders are partitioned by date, and
other dates' folders are neither read nor listed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import gold

POINT_KEYS = ("tag_name", "event_ts")
_LEDGER = "batch_id bigint, rows bigint, dates array<date>"
_BATCH = T.StructField("batch", T.LongType())


@dataclass
class DailyGold:
    """The tables under ``root``: ``layers`` maps a table to what rebuilds it from (layers so far, silver rows)."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]  # of a silver row; none: rows are the same if all their columns are
    ts_col: str
    layers: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]
    day_cols: dict[str, str] = field(default_factory=dict)  # of each layer, its date column's expression

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table)).drop("gold_date")

    def ledger(self) -> DataFrame:
        """(batch_id, rows, dates) of the finished batches."""
        return self.spark.read.schema(_LEDGER).json(self.path("ledger"))

    def _done(self, batch_id: int) -> bool:
        self.spark.createDataFrame([], _LEDGER).write.mode("ignore").json(self.path("ledger"))  # before the first batch
        return self.ledger().filter(F.col("batch_id") == batch_id).limit(1).count() > 0

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of silver rows."""
        if self._done(batch_id):
            return
        rows = batch.withColumn("event_date", F.to_date(self.ts_col)).filter("event_date IS NOT NULL")
        own = f"{self.path('silver')}/batch={batch_id}"
        # Rebalanced by date: a file per date, and several where one date is large.
        rows.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(own)
        seen = rows.sparkSession.read.schema(rows.schema).parquet(own) \
            .groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).orderBy("event_date").collect()  # a row per date
        dates = [r["event_date"] for r in seen]
        if dates:
            # Only the folders of these dates are listed; the ledger knows which finished batches have some.
            earlier = self.ledger().select("batch_id", F.explode("dates").alias("d")).filter(F.col("d").isin(dates))
            folders = {f"batch={b}/event_date={d}" for b, d in [*earlier.collect(), *((batch_id, d) for d in dates)]}
            silver = self.spark.read.schema(T.StructType([*rows.schema, _BATCH])) \
                .option("basePath", self.path("silver")).parquet(*[f"{self.path('silver')}/{f}" for f in sorted(folders)]) \
                .dropDuplicates(list(self.keys) or batch.columns)
            built, last = {"silver": silver}, list(self.layers)[-1]
            for table, rebuild in self.layers.items():
                built[table] = rebuild(built)
                day = F.expr(self.day_cols[table]).cast("date")
                built[table].withColumn("gold_date", day).hint("rebalance", "gold_date").write.mode("overwrite") \
                    .partitionBy("gold_date").option("partitionOverwriteMode", "dynamic").parquet(self.path(table))
                if table == last:
                    break
                # The next layer reads what was written, so nothing is computed twice.
                built[table] = self.spark.read.schema(built[table].schema).parquet(self.path(table)) \
                    .filter(day.isin(dates))
        done = self.spark.createDataFrame([(batch_id, sum(r["n"] for r in seen), dates)], _LEDGER)
        done.coalesce(1).write.mode("append").json(self.path("ledger"))

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())


def daily_health(spark: SparkSession, root: str, assets: DataFrame) -> DailyGold:
    """Hourly statistics (GLD-01) and daily health (GLD-02/03) from a stream of silver points."""
    return DailyGold(spark, root, POINT_KEYS, "event_ts", {
        "hourly": lambda t: gold.tag_hourly(t["silver"]),
        "health": lambda t: gold.health_daily(t["hourly"], assets),
    }, {"hourly": "to_date(hour_ts)", "health": "day_dt"})


def daily_oee(spark: SparkSession, root: str) -> DailyGold:
    """Daily line figures (GLD-05) from a stream of silver production events; an event counts for its start day.
    Event ids may repeat, so only equal rows are one event."""
    return DailyGold(spark, root, (), "event_start", {"oee": lambda t: gold.oee_daily(t["silver"])},
                     {"oee": "day_dt"})
