"""Time-series points: landed JSON arrays and message payloads (SRC-05/07, BRZ-01..04).

The reference polls an HTTP endpoint on the driver inside each micro-batch.
Here the points are read by executors: snapshots are landed as files (one
JSON array per file) or arrive as messages (one JSON array per message), and
:func:`bronze_points` is a plain projection usable in batch and streaming.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POINT_BATCH_SCHEMA, POINT_SCHEMA

# Fixed columns of the raw point table.
BRONZE_POINT_COLUMNS = ("tag_name", "asset_id", "event_ts", "value", "quality", "uom", "source_system",
                        "plant_id", "area_id", "ingest_ts", "raw_payload")


def bronze_points(points: DataFrame, ingest_ts: dt.datetime | None = None) -> DataFrame:
    """BRZ-01..04: parse the time text, stamp landing time, keep the record as JSON.

    ``event_ts`` is NULL for bad time text (the contract check quarantines
    it).  ``raw_payload`` leaves NULL fields out, as ``to_json`` does.
    """
    stamp = F.lit(ingest_ts).cast("timestamp") if ingest_ts is not None else F.current_timestamp()
    payload = F.to_json(F.struct(*[F.col(f.name) for f in POINT_SCHEMA.fields]))
    return points.select(
        "tag_name", "asset_id",
        F.col("timestamp").try_cast("timestamp").alias("event_ts"),
        "value", "quality", "uom", "source_system", "plant_id", "area_id",
        stamp.alias("ingest_ts"), payload.alias("raw_payload"),
    )


def read_point_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05 (batch): landed snapshot files, each a JSON array of points."""
    return spark.read.schema(POINT_SCHEMA).option("multiLine", True).json(path)


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """SRC-07: one message = one JSON array of points -> one row per point.

    Works on any text column (text files, Kafka ``CAST(value AS STRING)``).
    """
    return messages.select(F.explode(_points_of(column)).alias("p")).select("p.*")


def _points_of(column: str):
    return F.from_json(F.col(column).cast("string"), POINT_BATCH_SCHEMA)


def unreadable_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """STR-04: messages that hold no readable array of points, whole, with the reason (batch or stream)."""
    text = F.col(column).cast("string")
    return messages.filter(text.isNotNull() & _points_of(column).isNull()).select(
        text.alias("message"), F.lit("unreadable").alias("reject_reason"))
