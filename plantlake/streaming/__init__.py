"""Structured Streaming: file-stream ingest, dedup and the hourly window (STR-01..06).

``registry_entries`` runs the streams over messages landed from the driver's
``events`` table: the landing, checkpoint and sink folders live under the
shared ``spark.checkpoint.dir`` (a fresh sub-folder per run), the stream runs
with ``availableNow`` and the sink is then read back as a batch frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _run_dirs(spark: SparkSession, tag: str) -> dict:
    from ..session import shared_dir
    base = shared_dir(spark, "streams", f"{tag}-{uuid.uuid4().hex[:12]}")
    return {k: f"{base}/{k}" for k in ("landing", "bronze", "bronze_ckpt", "silver", "silver_ckpt",
                                       "hourly", "hourly_ckpt")}


def land_messages(spark: SparkSession, sf_dir: str, landing: str, files: int = 8) -> None:
    """Write the shim's point messages as text files (one JSON array per line)."""
    from ..sources import shims
    msgs = shims.point_messages(spark, sf_dir).unionByName(shims.broken_messages(spark, sf_dir))
    # rebalance by hour: about ``files`` files for small inputs, AQE-sized files (and more
    # writers) when the table is large, so landing never funnels into a fixed few tasks
    msgs.hint("rebalance", files, "_hour").select("value").write.mode("overwrite").text(landing)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01..05: messages -> bronze (file sink) -> deduplicated silver (file sink)."""
    from ..session import configure
    from .ingest import bronze_stream, point_message_stream, silver_stream, start_file_sink
    configure(spark)
    d = _run_dirs(spark, "ingest")
    land_messages(spark, sf_dir, d["landing"])
    bronze = bronze_stream(point_message_stream(spark, d["landing"]))
    q1 = start_file_sink(bronze, d["bronze"], d["bronze_ckpt"])
    q1.awaitTermination()
    bronze_again = spark.readStream.schema(spark.read.parquet(d["bronze"]).schema).parquet(d["bronze"])
    q2 = start_file_sink(silver_stream(bronze_again), d["silver"], d["silver_ckpt"])
    q2.awaitTermination()
    out = spark.read.parquet(d["silver"])
    return out.select("tag_name", "asset_id", "event_ts", "value", "quality", "uom", "source_system",
                      "plant_id", "area_id", "tag_suffix")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-04, DQ-01: what the stream cannot take: unreadable messages and points that break the contract."""
    from ..session import configure
    from .ingest import bronze_stream, point_message_stream, rejected_stream, start_file_sink, unreadable_stream
    configure(spark)
    d = _run_dirs(spark, "quarantine")
    land_messages(spark, sf_dir, d["landing"])
    q1 = start_file_sink(unreadable_stream(spark, d["landing"]), d["bronze"], d["bronze_ckpt"], partition_by=())
    rejected = rejected_stream(bronze_stream(point_message_stream(spark, d["landing"])))
    q2 = start_file_sink(rejected.select("tag_name", "event_ts", "reject_reason"), d["silver"], d["silver_ckpt"],
                         partition_by=())
    q1.awaitTermination()
    q2.awaitTermination()
    bad = spark.read.parquet(d["bronze"]).selectExpr("message", "CAST(NULL AS STRING) AS tag_name",
                                                     "CAST(NULL AS TIMESTAMP) AS event_ts", "reject_reason")
    return bad.unionByName(spark.read.parquet(d["silver"]).selectExpr("CAST(NULL AS STRING) AS message", "*"))


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06: windowed hourly aggregate in append mode (final windows only)."""
    from ..functions import round6
    from ..session import configure
    from .ingest import bronze_stream, hourly_stream, point_message_stream, silver_stream, start_file_sink
    configure(spark)
    d = _run_dirs(spark, "hourly")
    land_messages(spark, sf_dir, d["landing"])
    silver = silver_stream(bronze_stream(point_message_stream(spark, d["landing"])))
    q = start_file_sink(hourly_stream(silver), d["hourly"], d["hourly_ckpt"], partition_by=())
    q.awaitTermination()
    out = spark.read.parquet(d["hourly"])
    return out.select(*[round6(c).alias(c) if c in ("avg_value", "std_value") else c for c in out.columns])


def stream_daily_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06: daily health kept up by micro-batches in arbitrary order, each rebuilding only the dates it touches."""
    from ..functions import round6
    from ..operators import silver
    from ..session import configure
    from ..sources import shims
    from .daily import daily_health
    from .ingest import bronze_stream, point_message_stream
    configure(spark)
    d = _run_dirs(spark, "daily")
    land_messages(spark, sf_dir, d["landing"])
    points = bronze_stream(point_message_stream(spark, d["landing"], max_files_per_trigger=4))
    assets = silver.silver_assets(shims.assets_raw(spark, sf_dir))
    tables = daily_health(spark, d["silver"], assets)
    tables.start(silver.silver_points(points), d["silver_ckpt"]).awaitTermination()
    rounded = ("vib", "bearing_temp", "motor_amps", "run_frac", "health_score")
    out = tables.read("health")
    return out.select(*[round6(c).alias(c) if c in rounded else c for c in out.columns])


def stream_daily_oee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06: daily line figures kept up by micro-batches of landed production events."""
    from ..operators import silver
    from ..session import configure
    from ..sources import shims
    from .daily import daily_oee
    configure(spark)
    d = _run_dirs(spark, "oee")
    raw = shims.production_events_raw(spark, sf_dir)
    # No fixed number of partitions: where the table is large, each would be cut into many files with the same dates,
    # and every one of them would touch these dates again.
    raw.hint("rebalance", "event_start").write.parquet(d["landing"])
    landed = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 2).parquet(d["landing"])
    tables = daily_oee(spark, d["silver"])
    tables.start(silver.silver_production_events(landed), d["silver_ckpt"]).awaitTermination()
    return tables.read("oee")


def registry_entries() -> dict:
    return {"stream_ingest": stream_ingest, "stream_hourly": stream_hourly, "stream_quarantine": stream_quarantine,
            "stream_daily_health": stream_daily_health, "stream_daily_oee": stream_daily_oee}


def oracle_entries() -> dict:
    """Batch truth: distinct on-time silver points; hourly windows the watermark has passed."""
    return {
        "stream_ingest": """
SELECT DISTINCT ON (tag_name, event_ts) tag_name, asset_id, event_ts, value, quality, uom, source_system,
       plant_id, area_id, tag_suffix FROM silver_points""",
        "stream_quarantine": """
SELECT '[{"tag_name": "broken-' || CAST(event_id AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS tag_name,
       CAST(NULL AS TIMESTAMP) AS event_ts, 'unreadable' AS reject_reason FROM events WHERE event_id % 500 = 0
UNION ALL
SELECT NULL AS message, tag_name, event_ts, reason AS reject_reason FROM judged_points WHERE reason IS NOT NULL""",
        "stream_daily_health": """
SELECT plant_id, asset_id, asset_name, criticality, day_dt, round(vib + 1e-9, 6) AS vib,
       round(bearing_temp + 1e-9, 6) AS bearing_temp, round(motor_amps + 1e-9, 6) AS motor_amps,
       round(run_frac + 1e-9, 6) AS run_frac, round(health_score + 1e-9, 6) AS health_score, anomaly_flag,
       signals_observed FROM health""",
        "stream_daily_oee": """
WITH one AS (SELECT DISTINCT * FROM silver_production),
sums AS (
  SELECT plant_id, area_id, line_id, event_start::DATE AS day_dt,
         coalesce(sum(floor(epoch(event_end)) - floor(epoch(event_start))) FILTER (event_type = 'RUN'), 0) AS run_s,
         coalesce(sum(floor(epoch(event_end)) - floor(epoch(event_start))) FILTER (event_type = 'DOWNTIME'), 0) AS down_s,
         coalesce(sum(good_count), 0)::BIGINT AS good_count, coalesce(sum(scrap_count), 0)::BIGINT AS scrap_count,
         coalesce(sum(planned_count), 0)::BIGINT AS planned_count
  FROM one WHERE event_start IS NOT NULL GROUP BY ALL)
SELECT plant_id, area_id, line_id, day_dt, run_s / 3600.0 AS run_hours, down_s / 3600.0 AS down_hours, good_count,
       scrap_count, planned_count, CASE WHEN planned_count > 0 THEN good_count / planned_count::DOUBLE END AS quality_ratio,
       CASE WHEN run_s + down_s > 0 THEN run_s / (run_s + down_s) END AS availability_ratio
FROM sums""",
        "stream_hourly": """
SELECT plant_id, area_id, asset_id, tag_suffix, hour_ts, round(avg_value + 1e-9, 6) AS avg_value, max_value,
       min_value, round(std_value + 1e-9, 6) AS std_value, sample_count
FROM hourly
WHERE hour_ts + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM silver_points) - INTERVAL 1 HOUR""",
    }
