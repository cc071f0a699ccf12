"""One test per scalar / aggregate expression row (FN-01..19, AGG-01..06), with edge values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plantlake.functions import (
    as_timestamp,
    as_type,
    empty_to_null,
    hours_between,
    overlaps,
    pseudonym,
    regex_quote,
    round6,
    safe_ratio,
    technician_role,
)


def one(spark, ddl, row, *cols):
    return spark.createDataFrame([row], ddl).select(*cols).first()


def test_fn01_cast_date(spark):
    r = one(spark, "s string", ("2018-03-15",), as_type("s", "date").alias("d"))
    assert r.d == dt.date(2018, 3, 15)
    r = one(spark, "s string", ("not a date",), as_type("s", "date").alias("d"))
    assert r.d is None


def test_fn02_cast_timestamp_z_offset_bad(spark):
    df = spark.createDataFrame([("2026-08-10T05:55:00Z",), ("2026-08-10T07:55:00+02:00",), ("garbage",), ("",)], "s string")
    got = [r.t for r in df.select(as_timestamp("s").alias("t")).collect()]
    assert got[0] == got[1] == dt.datetime(2026, 8, 10, 5, 55)
    assert got[2] is None and got[3] is None


def test_fn03_cast_numbers(spark):
    df = spark.createDataFrame([("12",), ("",), (" ",), ("n/a",), ("6.5",)], "s string")
    got = [(r.i, r.d) for r in df.select(as_type("s", "int").alias("i"), as_type("s", "double").alias("d")).collect()]
    assert got[0] == (12, 12.0) and got[1] == (None, None) and got[3] == (None, None) and got[4] == (None, 6.5)


def test_fn04_nullif_blank_is_not_empty(spark):
    df = spark.createDataFrame([("",), (" ",), (None,)], "s string")
    assert [r.s for r in df.select(empty_to_null("s").alias("s")).collect()] == [None, " ", None]


def test_fn06_in_drops_null(spark):
    df = spark.createDataFrame([("Good",), ("Bad",), (None,), ("Uncertain",)], "q string")
    assert df.filter(F.col("q").isin("Good", "Uncertain")).count() == 2


def test_fn07_case_without_else_and_role(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "p int")
    roles = [r.r for r in df.select(technician_role("p").alias("r")).collect()]
    assert roles == ["reliability_oncall", "reliability_oncall", "technician", "planner", "planner"]
    r = one(spark, "p int", (5,), F.when(F.col("p") == 1, "x").alias("v"))
    assert r.v is None


def test_fn08_regexp_replace_all_and_backrefs(spark):
    r = one(spark, "s string", ("aXbXc",), F.regexp_replace("s", "(?i)x", "-").alias("v"))
    assert r.v == "a-b-c"
    r = one(spark, "s string", ("a@b@c.com",), F.regexp_replace("s", "(^.).*(@.*$)", "$1***$2").alias("v"))
    assert r.v == "a***@c.com"  # greedy: the last '@' wins


def test_fn09_date_trunc_hour(spark):
    r = one(spark, "t timestamp", (dt.datetime(2024, 1, 1, 5, 59, 59, 999999),), F.date_trunc("HOUR", "t").alias("h"))
    assert r.h == dt.datetime(2024, 1, 1, 5)


def test_fn10_greatest_least_skip_null_nan(spark):
    r = one(spark, "a double", (None,), F.greatest(F.col("a") - 2.5, F.lit(0.0)).alias("g"),
            F.least(F.lit(100.0), F.col("a")).alias("l"))
    assert r.g == 0.0 and r.l == 100.0
    r = one(spark, "a double", (float("nan"),), F.greatest(F.col("a"), F.lit(0.0)).alias("g"),
            (F.col("a") > 4.0).alias("gt"))
    assert math.isnan(r.g) and r.gt is True  # T19: NaN is the largest value


def test_fn11_unix_timestamp_whole_seconds(spark):
    r = one(spark, "s timestamp, e timestamp",
            (dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 1, 0, 0, 100000)),
            hours_between("s", "e").alias("h"))
    assert r.h == 1.0


def test_fn12_coalesce_and_safe_ratio(spark):
    r = one(spark, "a bigint, b bigint", (5, 0), safe_ratio(F.col("a"), F.col("b")).alias("r"),
            F.coalesce(F.lit(None).cast("double"), F.lit(1.0)).alias("c"))
    assert r.r is None and r.c == 1.0


def test_fn13_14_as_of_windows(spark):
    from plantlake.operators.metrics import day_window
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (23, 24, 30, 31)] + [(dt.date(2024, 2, 1),)], "day_dt date")
    got = sorted(r.day_dt.day for r in df.filter(day_window("day_dt", 7, "2024-01-31 00:00:00")).collect())
    assert got == [24, 30, 31]  # inclusive lower bound (8 dates), nothing after as_of


def test_fn15_three_valued_logic(spark):
    r = one(spark, "v double, t double", (None, 90.0), ((F.col("v") > 4.0) | (F.col("t") > 85)).alias("o"),
            ((F.col("v") > 4.0) & (F.col("t") > 85)).alias("a"))
    assert r.o is True and r.a is None


def test_fn16_17_null_checks_concat_right(spark):
    r = one(spark, "s string", (None,), F.col("s").isNull().alias("n"),
            F.concat(F.lit("plant_"), F.col("s")).alias("c"), F.right(F.col("s"), F.lit(4)).alias("r"))
    assert r.n is True and r.c is None and r.r is None


def test_fn18_to_json_leaves_nulls_out(spark):
    r = one(spark, "a string, b double", ("x", None), F.to_json(F.struct("a", "b")).alias("j"))
    assert r.j == '{"a":"x"}'


def test_fn19_alias_drop_star(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert df.select(F.col("a").alias("z"), "*").drop("b").columns == ["z", "a"]


def test_agg01_02_avg_skips_null_stddev_single(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", None), ("j", 3.0)], "k string, v double")
    got = {r.k: (r.a, r.s, r.n) for r in df.groupBy("k").agg(
        F.avg("v").alias("a"), F.stddev_samp("v").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    assert got["k"] == (1.0, None, 2) and got["j"] == (3.0, None, 1)


def test_agg03_05_conditional_aggregates(spark):
    df = spark.createDataFrame([("RUN", 10, True), ("DOWNTIME", 5, None), ("RUN", 1, False)], "t string, d int, f boolean")
    r = df.agg(F.sum(F.when(F.col("t") == "RUN", F.col("d")).otherwise(0)).alias("run"),
               F.max(F.when(F.col("t") == "DOWNTIME", F.col("d"))).alias("mx"),
               F.count_if(F.col("f")).alias("c")).first()
    assert (r.run, r.mx, r.c) == (11, 5, 1)


def test_agg06_group_by_expression(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 10), 1.0), (dt.datetime(2024, 1, 1, 5, 50), 3.0)], "t timestamp, v double")
    r = df.groupBy(F.date_trunc("HOUR", "t").alias("h")).agg(F.avg("v").alias("a")).first()
    assert r.a == 2.0


def test_overlap_predicate_open_end(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), None), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1))],
                               "s timestamp, e timestamp")
    lo, hi = F.lit("2024-01-01 02:00:00").cast("timestamp"), F.lit("2024-01-01 03:00:00").cast("timestamp")
    assert df.filter(overlaps("s", "e", lo, hi)).count() == 1


def test_pseudonym_and_round6(spark):
    r = one(spark, "i string, x double", (None, 0.5203125), pseudonym("i", "salt").alias("p"), round6("x").alias("r"))
    assert r.p is None and r.r == pytest.approx(0.520313)
    r = one(spark, "i string", ("E1",), pseudonym("i", "salt").alias("p"))
    import hashlib
    assert r.p == hashlib.sha256(b"saltE1").hexdigest()


def test_regex_quote():
    assert regex_quote("O'Neil (Jr.)") == "O\\'Neil \\(Jr\\.\\)"
