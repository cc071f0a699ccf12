"""As-of join, interval coalescing, change rows and incremental daily gold against plain versions."""

import datetime as dt
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from plantlake.operators import gold, tools
from plantlake.plans.asof import asof_join
from plantlake.plans.changes import apply_changes, table_changes
from plantlake.plans.intervals import hours_once, merged_intervals, overlap_check
from plantlake.streaming.daily import daily_health, daily_oee

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


# -- as-of join ----------------------------------------------------------------------

LEFT, RIGHT = "lid int, key string, ts timestamp, value string", "key string, ts timestamp, value int, note string"


def naive_asof(left, right, tolerance=None):
    out = []
    for row in left:
        _, key, ts, _ = row
        found = [(r[1], r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "") + (r,) for r in right
                 if key is not None and ts is not None and r[0] == key and r[1] is not None and r[1] <= ts]
        best = max(found)[-1] if found else None
        if best and tolerance is not None and best[1] < ts - tolerance:
            best = None
        out.append((*row, best and best[2], best and best[3]))
    return out


@pytest.mark.parametrize("bucket", ["7 minutes", "1 day"])
def test_asof_equals_the_plain_search(spark, bucket):
    rng = random.Random(1)
    key = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    left = [(i, key(), at(rng.choice([None, *range(0, 3000, 3)])), "x") for i in range(300)] + [(0, "a", at(9), "x")] * 2
    right = [(key(), at(rng.choice([None, *range(500, 2500)])), rng.choice([None, 1, 2]), rng.choice([None, "n", "m"]))
             for _ in range(200)]
    right += [("b", at(100), 1, "m"), ("b", at(100), 1, "n"), ("b", at(100), None, "z")]
    lf, rf = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    columns = {"reading": "value", "said": "note"}
    got = asof_join(lf, rf, ["key"], "ts", "ts", columns, bucket=bucket)
    assert got.columns == [*lf.columns, "reading", "said"]
    assert Counter(rows(got)) == Counter(naive_asof(left, right))
    near = asof_join(lf, rf, ["key"], "ts", "ts", columns, bucket=bucket, tolerance="90 minutes")
    assert Counter(rows(near)) == Counter(naive_asof(left, right, dt.timedelta(minutes=90)))
    assert Counter(rows(asof_join(lf, rf.limit(0), ["key"], "ts", "ts", columns))) == Counter(naive_asof(left, []))
    assert asof_join(lf.limit(0), rf, ["key"], "ts", "ts", columns).count() == 0
    with pytest.raises(ValueError, match="value"):
        asof_join(lf, rf, ["key"], "ts", "ts", {"Value": "value"})


def test_asof_spreads_a_hot_key_over_its_buckets(spark):
    """No window, sort or aggregate sees the hot key's rows as one group."""
    n, per_day = 20_000, 1440
    points = spark.range(n).select(F.lit("hot").alias("key"), (F.lit(T0) + F.make_interval(mins=F.col("id").cast("int")))
                                   .alias("ts"), F.col("id").cast("int").alias("value"), F.lit("n").alias("note"))
    asked = spark.range(0, n, 7).select(F.col("id").cast("int").alias("lid"), F.lit("hot").alias("key"), (
        F.lit(T0) + F.make_interval(mins=F.col("id").cast("int"), secs=F.lit(30))).alias("ts"), F.lit("x").alias("value"))
    got = asof_join(asked, points, ["key"], "ts", "ts", {"reading": "value"})
    assert got.filter("reading != lid").count() == 0 and got.count() == asked.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and "Join" not in plan
    # the window over the key alone reads one aggregated row per bucket, of which there are n / per_day
    assert sum(", [k0#" in w and "b#" in w.split("], [")[1] for w in windows) >= 1 and n // per_day < 20


def test_alarm_context_takes_crews_on_duty_only(spark):
    alarms = spark.createDataFrame([("1", "P", "A", at(65)), ("2", "P", "A", at(150)), ("3", "P", "B", at(65)),
                                    ("4", "Q", "A", at(65)), ("5", "P", "A", None)],
                                   "alarm_id string, plant_id string, asset_id string, raised_at timestamp")
    points = spark.createDataFrame([("P", "A", "Vibration", at(60), 1.0), ("P", "A", "Vibration", at(66), 9.0),
                                    ("P", "A", "MotorAmps", at(64), 5.0), ("Q", "A", "Vibration", at(1), 7.0)],
                                   "plant_id string, asset_id string, tag_suffix string, event_ts timestamp, value double")
    shifts = spark.createDataFrame([("P", "X", at(0), at(60), "C1", "Night"), ("P", "X", at(60), at(120), "C2", "Day")],
                                   "plant_id string, area_id string, shift_start timestamp, shift_end timestamp, "
                                   "crew_id string, shift_name string")
    assets = spark.createDataFrame([("P", "A", "X"), ("P", "B", "X"), ("Q", "A", "X")],
                                   "plant_id string, asset_id string, area_id string")
    got = {r["alarm_id"]: (r["last_value"], r["crew_id"]) for r in
           tools.alarm_context(alarms, points, shifts, assets).collect()}
    assert got == {"1": (1.0, "C2"), "2": (9.0, None), "3": (None, "C2"), "4": (7.0, None), "5": (None, None)}


# -- intervals -----------------------------------------------------------------------

def random_events(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.randrange(0, 4 * 1440, 5)
        e = rng.choice([None, s - 5, s, s + 5, s + rng.randrange(5, 400, 5), s + 3000])
        out.append((f"e{i}", rng.choice(["P", None]) if i % 50 == 0 else "P", "X", rng.choice(["L1", "L1", "L2"]), "A",
                    at(s), at(e), rng.choice(["RUN", "DOWNTIME", "IDLE"]), rng.choice([None, 5]), 1, 10))
    return out


EVENTS = ("event_id string, plant_id string, area_id string, line_id string, asset_id string, event_start timestamp, "
          "event_end timestamp, event_type string, good_count bigint, scrap_count bigint, planned_count bigint")


def minutes_of(events, kinds):
    """Five-minute marks that events of some kinds cover, by line."""
    out = {}
    for e in events:
        if e[1] and e[6] and e[7] in kinds:
            t = e[5]
            while t < e[6]:
                out.setdefault((e[1], e[2], e[3]), Counter())[t] += 1
                t += dt.timedelta(minutes=5)
    return out


def test_every_instant_counts_once(spark):
    events = random_events(200, 3) + random_events(40, 3)[:10]
    df = spark.createDataFrame(events, EVENTS)
    down, both = minutes_of(events, {"DOWNTIME"}), minutes_of(events, {"RUN", "DOWNTIME"})
    want = {}
    for line, marks in both.items():
        for t in marks:
            run, stop = want.setdefault((*line, t.date()), [0, 0])
            is_down = t in down.get(line, ())
            want[(*line, t.date())] = [run + (not is_down) / 12, stop + is_down / 12]
    got = {tuple(r)[:4]: tuple(r)[4:] for r in rows(hours_once(df, list(gold.LINE)))}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    once = {tuple(r)[:4]: r for r in rows(gold.oee_once(df))}
    assert set(want) <= set(once)
    assert sum(r[6] for r in once.values()) == sum(e[8] or 0 for e in events)
    assert all(once[k][4:6] == pytest.approx(want[k]) for k in want)
    default = {tuple(r)[:4] for r in rows(gold.oee_daily(df))}
    assert {k for k, r in once.items() if r[8]} <= default  # counts stay on the start day


def test_islands_are_stitched_over_days(spark):
    events = random_events(150, 8)
    df = spark.createDataFrame(events, EVENTS).filter("event_type = 'DOWNTIME'")
    got = rows(merged_intervals(df, ["plant_id", "line_id"], "event_start", "event_end"))
    want = []
    for line in ("L1", "L2"):
        open_ = None
        for e in sorted((e for e in events if e[1] and e[3] == line and e[7] == "DOWNTIME" and e[6] and e[6] > e[5]),
                        key=lambda e: (e[5], e[6])):
            if open_ and e[5] <= open_[3]:
                open_[3], open_[4] = max(open_[3], e[6]), open_[4] + 1
            else:
                open_ = ["P", line, e[5], e[6], 1]
                want.append(open_)
    assert Counter(got) == Counter(map(tuple, want)) and any(e.date() > s.date() for _, _, s, e, _ in got)
    ties = spark.createDataFrame([("P", at(0), at(9))] * 5 + [("P", at(9), at(10)), ("P", at(11), at(12))],
                                 "k string, s timestamp, e timestamp")
    assert sorted(rows(merged_intervals(ties, ["k"], "s", "e"))) == [("P", at(0), at(10), 6), ("P", at(11), at(12), 1)]


def test_overlaps_are_reported(spark):
    df = spark.createDataFrame([("a", at(0), at(60)), ("a", at(30), at(90)), ("a", at(1440), at(1500)),
                                ("b", at(0), at(60)), ("b", at(60), at(70)), ("c", at(9), None), (None, at(0), at(9))],
                               "k string, s timestamp, e timestamp")
    assert rows(overlap_check(df, "t", ["k"], "s", "e")) == [("t", 3, 1, 13200.0, 1800.0)]
    assert rows(overlap_check(df.limit(0), "t", ["k"], "s", "e")) == [("t", 0, 0, 0.0, 0.0)]


def test_only_running_knows_the_plant(spark):
    """An asset id that two plants use: one stands, the other runs."""
    points = spark.createDataFrame(
        [(p, "R", "X", tag, at(0), v) for p, run in (("P1", 1.0), ("P2", 0.0)) for tag, v in (("RunStatus", run), ("MotorAmps", 5.0))],
        "plant_id string, area_id string, asset_id string, tag_suffix string, event_ts timestamp, value double")
    got = {(r["plant_id"], r["tag_suffix"]) for r in gold.tag_hourly(points, only_running=True).collect()}
    assert got == {("P1", "RunStatus"), ("P1", "MotorAmps")}


def test_islands_of_equal_pieces_equal_a_plain_merge(spark):
    rng = random.Random(11)
    at = lambda h: T0 + dt.timedelta(hours=h)
    data = []
    for _ in range(250):  # few starts and ends, so many pieces tie, and some islands run over days
        h = rng.randrange(0, 200, 6)
        data.append((rng.choice("PQ"), at(h), at(h + rng.choice((0, 2, 4, 6, 30)))))
    data += data[:40]
    expected = []
    for key in "PQ":
        for s, e in sorted((s, e) for k, s, e in data if k == key and e > s):
            if expected and expected[-1][0] == key and s <= expected[-1][2]:
                expected[-1][2], expected[-1][3] = max(expected[-1][2], e), expected[-1][3] + 1
            else:
                expected.append([key, s, e, 1])
    df = spark.createDataFrame(data, "k string, s timestamp, e timestamp").repartition(5)
    assert sorted(rows(merged_intervals(df, ["k"], "s", "e"))) == sorted(map(tuple, expected))


# -- changes -------------------------------------------------------------------------

def test_changes_lead_from_old_to_new(spark):
    rng = random.Random(6)
    row = lambda: (rng.choice([None, *range(12)]), rng.choice([None, "", "null", "x"]), rng.choice([None, 1.5, 2.0]))
    schema = "id int, text string, _n double"
    for size in (0, 40, 200):
        old = [row() for _ in range(size)]
        new = rng.sample(old, len(old) * 2 // 3) + [row() for _ in range(20)]
        o, n = spark.createDataFrame(old, schema).repartition(3), spark.createDataFrame(new, schema)
        changes = table_changes(o, n, ["id"]).cache()
        assert Counter(rows(apply_changes(o, changes))) == Counter(new)
        got = Counter(rows(changes))
        went, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
        assert Counter(r[:3] for r in got.elements() if r[3] in ("delete", "update_before")) == went
        assert Counter(r[:3] for r in got.elements() if r[3] in ("insert", "update_after")) == came
        both = {r[0] for r in went} & {r[0] for r in came} - {None}
        assert all((r[0] in both) == r[3].startswith("update") for r in got)
        assert table_changes(n, n, ["id"]).count() == 0
    with pytest.raises(ValueError, match="columns"):
        table_changes(o, n.drop("text"), ["id"])


# -- incremental daily gold ------------------------------------------------------------

SILVER = ("tag_name string, asset_id string, event_ts timestamp, value double, quality string, plant_id string, "
          "area_id string, tag_suffix string")


def _points(batch, days, seed):
    rng = random.Random(seed)
    return [(f"t|{s}", a, T0 + dt.timedelta(days=d, minutes=rng.randrange(1440), seconds=batch), rng.random() * 9, "Good",
             "P", "X", s) for d in days for a in ("A", "B") for s in ("Vibration", "MotorAmps") for _ in range(4)]


@pytest.fixture
def assets(spark):
    return spark.createDataFrame([("P", "A", "pump", "HIGH")], "plant_id string, asset_id string, asset_name string, criticality string")


def _health(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)), key=str)


def test_daily_gold_survives_replays_and_late_rows(spark, tmp_path, assets):
    tables = daily_health(spark, str(tmp_path / "gold"), assets)
    batches = [_points(0, (0, 1), 1), _points(1, (1, 2), 2), _points(2, (0,), 3) + _points(0, (0, 1), 1)[:5], []]
    for i, batch in enumerate(batches):
        tables.apply(spark.createDataFrame(batch, SILVER), i)
        tables.apply(spark.createDataFrame(batch, SILVER), i)  # replayed after its commit: skipped
    every = spark.createDataFrame(sum(batches, []), SILVER).dropDuplicates(["tag_name", "event_ts"])
    hourly = gold.tag_hourly(every)
    assert _health(tables.read("health")) == _health(gold.health_daily(hourly, assets))
    assert tables.read("hourly").count() == hourly.count()
    ledger = {r["batch_id"]: (r["rows"], len(r["dates"])) for r in tables.ledger().collect()}
    assert ledger == {0: (32, 2), 1: (32, 2), 2: (21, 1), 3: (0, 0)}  # 5 of the first batch's rows came again


def test_daily_gold_touches_only_its_dates(spark, tmp_path, assets):
    tables = daily_health(spark, str(tmp_path / "gold"), assets)
    tables.apply(spark.createDataFrame(_points(0, (0, 1, 2), 1), SILVER), 0)
    files = lambda: {f for d, _, names in os.walk(tmp_path / "gold" / "health") for f in names if f.endswith("parquet")
                     and "gold_date=2024-01-02" not in d}
    before = files()
    tables.apply(spark.createDataFrame(_points(1, (1,), 2), SILVER), 1)
    assert files() == before


def test_a_batch_lists_only_the_folders_of_its_dates(spark, tmp_path, assets):
    tables = daily_health(spark, str(tmp_path / "gold"), assets)
    hourly, listed = tables.layers["hourly"], []
    tables.layers["hourly"] = lambda t: (listed.append({f.rsplit("/", 2)[0].rsplit("/", 1)[1] + "/" + f.rsplit("/", 2)[1]
                                                        for f in t["silver"].inputFiles()}), hourly(t))[1]
    for batch_id, days in enumerate(((0, 1, 2), (1, 3), (2, 3))):
        tables.apply(spark.createDataFrame(_points(batch_id, days, batch_id), SILVER), batch_id)
    folders = lambda *of: {f"batch={b}/event_date={(T0 + dt.timedelta(days=d)).date()}" for b, d in of}
    assert listed[1:] == [folders((0, 1), (1, 1), (1, 3)), folders((0, 2), (2, 2), (1, 3), (2, 3))]


def test_daily_gold_after_a_crash_between_write_and_commit(spark, tmp_path, assets):
    landing, ckpt = tmp_path / "landing", str(tmp_path / "ckpt")
    os.makedirs(landing)

    def land(name, batch):
        with open(landing / name, "w") as fh:
            for r in batch:
                fh.write(json.dumps(dict(zip([c.split()[0] for c in SILVER.split(", ")], r)), default=str) + "\n")

    tables = daily_health(spark, str(tmp_path / "gold"), assets)
    stream = lambda: spark.readStream.schema(SILVER).option("maxFilesPerTrigger", 1).json(str(landing))
    land("a.json", _points(0, (0, 1), 1))
    tables.start(stream(), ckpt).awaitTermination()
    land("b.json", _points(1, (1, 2), 2))
    real = tables._done
    crash = iter([True])

    def lost(batch_id):  # the batch's silver rows are written, then the driver is lost before gold and the commit
        if batch_id == 1 and next(crash, False):
            batch = spark.read.schema(SILVER).json(str(landing / "b.json")).withColumn("event_date", F.to_date("event_ts"))
            batch.write.mode("overwrite").partitionBy("event_date").parquet(f"{tables.path('silver')}/batch=1")
            raise RuntimeError("driver lost")
        return real(batch_id)

    tables._done = lost
    with pytest.raises(Exception, match="driver lost"):
        tables.start(stream(), ckpt).awaitTermination()
    tables._done = real
    tables.start(stream(), ckpt).awaitTermination()
    land("late.json", _points(2, (0,), 3))
    tables.start(stream(), ckpt).awaitTermination()
    tables.start(stream(), ckpt).awaitTermination()  # nothing new: adds nothing
    every = spark.createDataFrame(_points(0, (0, 1), 1) + _points(1, (1, 2), 2) + _points(2, (0,), 3), SILVER)
    assert _health(tables.read("health")) == _health(gold.health_daily(gold.tag_hourly(every), assets))
    assert sorted(r["batch_id"] for r in tables.ledger().collect()) == [0, 1, 2]


def test_daily_oee_equals_the_rebuild(spark, tmp_path):
    events = random_events(120, 5)
    tables = daily_oee(spark, str(tmp_path / "oee"))
    for i in range(3):
        tables.apply(spark.createDataFrame(events[i::3] + events[:4], EVENTS), i)
    assert _health(tables.read("oee")) == _health(gold.oee_daily(spark.createDataFrame(events, EVENTS)))


# -- header versions, whole-or-nothing tables, replayable polls -----------------------

def test_csv_header_versions_and_rescued_cells(spark, tmp_path):
    from plantlake.schemas import CSV_COLUMNS
    from plantlake.sources.csv import header_versions, load_csv, load_csv_versions, rescued_cells
    cols = list(CSV_COLUMNS["assets"])
    cells = [f"v{k}" for k in range(len(cols))]

    def land(name, header, *lines):
        (tmp_path / "in" / name).write_text("\n".join([",".join(header), *lines]) + "\n")

    (tmp_path / "in").mkdir()
    assert load_csv_versions(spark, str(tmp_path / "in"), "assets").count() == 0
    land("a.csv", cols, ",".join(cells), ",".join([*cells[:-1], '"two\nlines, ""quoted"""']))
    land("b [x]%.csv", cols[::-1], ",".join(cells[::-1]))
    land("c.csv", ["site", *cols[1:], "site", ""], "S," + ",".join(cells[1:]) + ",two,three")
    land("d.csv", cols, ",".join([*cells, "extra"]), ",".join(cells[:2]))
    land("e.csv", cols)  # a header alone
    raw = load_csv_versions(spark, str(tmp_path / "in"), "assets")
    got = {(r.source_file, r[cols[0]], r[cols[-1]], r.rescued_data) for r in raw.collect()}
    assert got == {
        ("a.csv", "v0", cells[-1], None), ("a.csv", "v0", 'two\nlines, "quoted"', None),
        ("b%20%5Bx%5D%25.csv", "v0", cells[-1], None),
        ("c.csv", None, cells[-1], f'{{"site":"S","_column_{len(cols) + 1}":"two","_column_{len(cols) + 2}":"three"}}'),
        ("d.csv", "v0", cells[-1], '{"_record":"' + ",".join([*cells, "extra"]) + '"}'),
        ("d.csv", "v0", None, '{"_record":"v0,v1"}')}
    assert raw.filter("rescued_data is not null").count() == 3
    assert {(r.column_name, r.rows) for r in rescued_cells(raw).collect()} == {
        ("site", 1), (f"_column_{len(cols) + 1}", 1), (f"_column_{len(cols) + 2}", 1), ("_record", 2)}
    assert len(header_versions(spark, str(tmp_path / "in"))) == 3
    one = load_csv(spark, str(tmp_path / "in" / "d.csv"), "assets")
    assert one.count() == 2


def test_replace_table_is_whole_or_nothing(spark, tmp_path):


    from plantlake.plans.versions import drop_versions, read_current, replace_table, versions
    path = str(tmp_path / "t")
    assert versions(spark, path) == [] and drop_versions(spark, path) == []
    assert replace_table(spark.range(10), path, table="default.whole_probe") == 10
    before = read_current(spark, path)
    # the next version reads the current one and has another schema
    assert replace_table(before.withColumn("twice", F.col("id") * 2).filter("id < 7"), path,
                         table="default.whole_probe") == 7
    assert spark.table("default.whole_probe").columns == ["id", "twice"]
    assert before.count() == 10  # a reader that began earlier keeps its version
    bad = spark.range(0, 100, 1, 8).withColumn("twice", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        replace_table(bad, path, table="default.whole_probe")
    assert read_current(spark, path).count() == 7 and spark.table("default.whole_probe").count() == 7
    assert [n for n, _, _ in versions(spark, path)] == [1, 2]
    assert replace_table(spark.range(0), path, table="default.whole_probe") == 0  # an empty table replaces, too
    assert spark.table("default.whole_probe").count() == 0
    drop_versions(spark, path, keep=1, leftovers=True)
    assert [d for d in os.listdir(path) if d.startswith("data-")] == [versions(spark, path)[-1][1]]
    assert read_current(spark, path).count() == 0
    with pytest.raises(ValueError):
        drop_versions(spark, path, keep=0)
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert read_current(spark, plain).count() == 3
    spark.sql("DROP VIEW default.whole_probe")


def test_live_views_follow_their_tables(spark, tmp_path):
    from conftest import SF_SMALL
    from plantlake.operators import serving, silver
    from plantlake.plans.pipeline import run_batch
    from plantlake.plans.versions import replace_table
    from plantlake.sources import shims
    raw = {name: fn(spark, SF_SMALL) for name, fn in shims.RAW_SHIMS.items()}
    root, p = str(tmp_path / "lake"), "views_"
    run_batch(spark, raw, root, register=True, prefix=p)
    for name, fn, table in (("work_orders", serving.serving_work_orders, "silver.work_orders"),
                            ("alarms", serving.serving_alarms, "silver.alarms"),
                            ("production_events", serving.serving_production_events, "silver.production_events")):
        view, want = spark.table(f"{p}serving_safe.{name}"), fn(spark.table(f"{p}{table}"))
        assert view.columns == want.columns and view.exceptAll(want).count() == want.exceptAll(view).count() == 0
    assert spark.table(f"{p}serving_safe.pi_timeseries_recent").count() == 0  # all points are old by now
    replace_table(silver.silver_alarms(raw["alarms_raw"].limit(5)), f"{root}/silver/alarms", table=f"{p}silver.alarms")
    assert spark.newSession().table(f"{p}serving_safe.alarms").count() == 5


def test_stored_polls_replay_and_failures_leave_nothing(spark, tmp_path):
    from pathlib import Path

    from pyspark.errors import StreamingQueryException

    from plantlake.sources.points import bronze_points
    from plantlake.sources.pysource import PointPollSource
    spark.dataSource.register(PointPollSource)
    store = tmp_path / "store"
    options = {"endpoints": f"{tmp_path}/PLANT-01,{tmp_path}/PLANT-02", "ticks": "2", "store": str(store)}

    def run(fetcher):
        points = spark.readStream.format("plant_points").options(fetcher=fetcher, **options).load()
        return (bronze_points(points).writeStream.format("parquet").trigger(availableNow=True)
                .option("checkpointLocation", str(tmp_path / "ck")).start(str(tmp_path / "out")))

    with pytest.raises(StreamingQueryException):
        run("fake_source:fail_after_one").awaitTermination()
    assert list(Path(store).rglob("*.jsonl")) == [] and list(Path(store).rglob("*.part")) == []
    for side in ("one", "two"):  # the same batch after a restart: the second time no poll is needed
        run("fake_source:fetch" if side == "one" else "fake_source:fail_after_one").awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    assert len(list(Path(store).rglob("2.jsonl"))) == 2
    again = (spark.readStream.format("plant_points").options(fetcher="fake_source:fail_after_one", **options).load()
             .writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "ck2")).start(str(tmp_path / "out2")))
    again.awaitTermination()
    cols = ["tag_name", "asset_id", "value"]
    assert (sorted(map(tuple, spark.read.parquet(str(tmp_path / "out2")).select(cols).collect()))
            == sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(cols).collect())))
