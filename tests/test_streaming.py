"""Streaming: file stream == batch over distinct on-time rows; restart adds nothing; poll source."""

import datetime as dt
import json
import os
import random
import time

from pyspark.sql import functions as F

from plantlake.operators import gold, silver
from plantlake.sources.points import bronze_points, read_point_files
from plantlake.streaming.ingest import (
    LateRows,
    bronze_stream,
    hourly_stream,
    point_file_stream,
    silver_stream,
    start_file_sink,
)

T0 = dt.datetime(2026, 8, 10, 6, 0, 0)


def _point(asset, suffix, minute, value, q="Good"):
    ts = (T0 + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"tag_name": f"\\\\PLANT-01\\{asset}|{suffix}", "asset_id": asset, "timestamp": ts, "value": value,
            "quality": q, "uom": "u", "source_system": "mock_pi", "plant_id": "PLANT-01", "area_id": "AREA-COMPRESS"}


def _land(folder, snapshots):
    os.makedirs(folder, exist_ok=True)
    base = 1_700_000_000
    for i, snap in enumerate(snapshots):
        path = os.path.join(folder, f"snap-{i:04d}.json")
        with open(path, "w") as fh:
            json.dump(snap, fh)
        os.utime(path, (base + 10 * i, base + 10 * i))  # the file source reads in modification order


def _points(n=240, seed=7):
    rnd = random.Random(seed)
    pts = [_point(a, s, m, round(rnd.uniform(0, 10), 3), rnd.choice(["Good", "Good", "Uncertain", "Bad"]))
           for m in range(n) for a, s in (("PMP-12", "Vibration"), ("CMP-03", "MotorAmps"))]
    return pts


def _split(points, parts, seed=3):
    rnd = random.Random(seed)
    cuts = sorted(rnd.sample(range(1, len(points)), parts - 1))
    out, prev = [], 0
    for c in cuts + [len(points)]:
        out.append(points[prev:c])
        prev = c
    return out


def test_stream_equals_batch_with_duplicates_and_restart(spark, tmp_path):
    pts = _points()
    snaps = _split(pts, 6)
    snaps.append(pts[100:130])  # a retried poll: duplicates of earlier points
    land = str(tmp_path / "landing")
    _land(land, snaps)
    bronze_p, silver_p = str(tmp_path / "bronze"), str(tmp_path / "silver")
    q = start_file_sink(bronze_stream(point_file_stream(spark, land, max_files_per_trigger=2)), bronze_p,
                        str(tmp_path / "ck_b"))
    q.awaitTermination()
    schema = spark.read.parquet(bronze_p).schema
    q2 = start_file_sink(silver_stream(spark.readStream.schema(schema).parquet(bronze_p)), silver_p,
                         str(tmp_path / "ck_s"))
    q2.awaitTermination()
    got = spark.read.parquet(silver_p)
    truth = silver.silver_points(bronze_points(read_point_files(spark, land)), dedup=True)
    cols = ["tag_name", "event_ts", "value", "quality", "tag_suffix"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, truth.select(cols).collect()))
    assert spark.read.parquet(bronze_p).count() == len(pts) + 30  # bronze keeps every row
    # restart from the checkpoints: nothing new
    q3 = start_file_sink(silver_stream(spark.readStream.schema(schema).parquet(bronze_p)), silver_p,
                         str(tmp_path / "ck_s"))
    q3.awaitTermination()
    assert spark.read.parquet(silver_p).count() == got.count()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    on_time = [_point("PMP-12", "Vibration", m, 1.0) for m in range(0, 600, 10)]
    more = [_point("PMP-12", "Vibration", 610, 1.0)]
    late = [_point("PMP-12", "Vibration", 5, 99.0)]  # 9+ hours behind the watermark
    land = str(tmp_path / "landing")
    # With chained stateful operators Spark filters late rows by the previous
    # batch's watermark, so the late file comes two batches after the jump.
    _land(land, [on_time, more, late])
    late_rows = LateRows()
    spark.streams.addListener(late_rows)
    q = start_file_sink(hourly_stream(silver_stream(bronze_stream(point_file_stream(spark, land, 1)))),
                        str(tmp_path / "hourly"), str(tmp_path / "ck"), partition_by=())
    q.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    out = spark.read.parquet(str(tmp_path / "hourly"))
    assert out.filter(F.col("max_value") == 99.0).count() == 0
    for _ in range(100):  # events reach the listener a little later
        if late_rows.of(q):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late_rows)
    assert late_rows.of(q) >= 1
    # windows the watermark passed are final and equal the batch aggregate
    batch = gold.tag_hourly(silver.silver_points(bronze_points(
        spark.createDataFrame(on_time, "tag_name string, asset_id string, timestamp string, value double, quality string, "
                                       "uom string, source_system string, plant_id string, area_id string"))))
    b = {r.hour_ts: r.sample_count for r in batch.collect()}
    b[dt.datetime(2026, 8, 10, 16)] = b.get(dt.datetime(2026, 8, 10, 16), 0) + 1
    for r in out.collect():
        assert b[r.hour_ts] == r.sample_count


def test_poll_source_batch_and_stream(spark, tmp_path):
    from plantlake.sources.pysource import PointPollSource
    spark.dataSource.register(PointPollSource)
    opts = {"endpoints": "http://plant/PLANT-01,http://plant/PLANT-02", "fetcher": "fake_source:fetch"}
    df = spark.read.format("plant_points").options(**opts).load()
    assert df.count() == 6
    stream = spark.readStream.format("plant_points").options(ticks="3", **opts).load()
    q = start_file_sink(bronze_stream(stream), str(tmp_path / "b"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "b"))
    assert got.count() == 2 * 3  # one poll per endpoint and batch, however many ticks have passed
    assert got.filter(F.col("event_ts").isNull()).count() == 0


def test_src04_rate_source_as_load_generator(spark, tmp_path):
    # SRC-04: a rate source only as a clock / load generator; each tick becomes one
    # snapshot message (a JSON array of 7 readings) that runs the real parse -> bronze path
    from plantlake.sources.points import parse_messages
    suffixes = ["Vibration", "BearingTemp", "SuctionPressure", "DischargePressure", "MotorAmps", "RunStatus",
                "RuntimeHours"]
    sfx = "array(" + ", ".join(f"'{s}'" for s in suffixes) + ")"
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3)
             .option("startTimestamp", 1786000000000).option("advanceMillisPerBatch", 5000).load())
    messages = ticks.selectExpr(
        f"to_json(transform({sfx}, s -> named_struct('tag_name', concat(chr(92), chr(92), 'PLANT-01', chr(92), "
        "'PMP-12|', s), 'asset_id', 'PMP-12', 'timestamp', date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), "
        "'value', CAST(value AS DOUBLE), 'quality', 'Good', 'uom', 'u', 'source_system', 'mock_pi', "
        "'plant_id', 'PLANT-01', 'area_id', 'AREA-1'))) AS value")
    sink, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    for run in (1, 2):  # a restart from the checkpoint takes the next tick batch only
        start_file_sink(bronze_stream(parse_messages(messages)), sink, ckpt).awaitTermination()
        got = spark.read.parquet(sink)
        assert got.count() == 21 * run
    assert got.filter("event_ts IS NULL OR raw_payload IS NULL").count() == 0
    assert got.select("tag_name").distinct().count() == 7


def test_unreadable_messages_are_quarantined(spark):
    from plantlake.sources.points import parse_messages, unreadable_messages
    good = json.dumps([_point("PMP-12", "Vibration", 0, 1.0)])
    df = spark.createDataFrame([(good,), ('[{"tag_name": "cut',), ("no json",), (None,), ("[]",)], "value string")
    assert parse_messages(df).count() == 1
    assert sorted(r.message for r in unreadable_messages(df).collect()) == ['[{"tag_name": "cut', "no json"]
