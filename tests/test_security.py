"""Security tests: no identifiers in serving/metrics outputs, row filters, leak audit."""

from pyspark.sql import functions as F

from plantlake.config import REFERENCE_REDACT_NAMES
from plantlake.operators import gold, governance, metrics, serving, silver


def _outputs(fx):
    health_src = fx["assets"].select("asset_id", "plant_id")  # health needs hourly; use an empty shape
    out = gold.maintenance_outcomes(fx["work_orders"])
    oee = gold.oee_daily(fx["production_events"])
    return {
        "serving_work_orders": serving.serving_work_orders(fx["work_orders"]),
        "serving_alarms": serving.serving_alarms(fx["alarms"]),
        "serving_shifts": serving.serving_shifts(fx["shifts"]),
        "serving_assets": serving.serving_assets(fx["assets"]),
        "serving_oee": serving.serving_oee(oee),
        "serving_outcomes": serving.serving_outcomes(out),
        "metrics_mtbf": metrics.mtbf_proxy(out),
        "metrics_oee": metrics.oee_by_line(oee),
        "gold_outcomes": out,
        "assets_keys": health_src,
    }


def test_no_direct_identifier_columns(spark, fx):
    leaks = governance.schema_leaks(spark, _outputs(fx))
    assert leaks.count() == 0


def test_schema_check_finds_planted_column(spark, fx):
    bad = {"oops": fx["work_orders"].withColumn("technician_email", F.lit("x@y.com"))}
    assert [tuple(r) for r in governance.schema_leaks(spark, bad).collect()] == [("oops", "technician_email")]


def test_non_member_sees_no_other_plant(spark, raw):
    people = silver.shift_people(raw["shifts_raw"]).unionByName(
        silver.shift_people(raw["shifts_raw"]).withColumn("plant_id", F.lit("PLANT-02")))
    v = governance.secure_view(people, "shift_people", ["plant_PLANT-02"])
    assert {r.plant_id for r in v.collect()} == {"PLANT-02"}
    nul = people.withColumn("plant_id", F.lit(None).cast("string"))
    assert governance.secure_view(nul, "shift_people", ["plant_PLANT-02"]).count() == 0


def test_content_audit_finds_planted_values(spark):
    df = spark.createDataFrame([
        ("call +1-555-0101 now",), ("mail jordan.lee@example.com",), ("ask JORDAN LEE",), ("nothing",), (None,)],
        "txt string")
    r = governance.content_leaks(df, "t", ["txt"], REFERENCE_REDACT_NAMES).first()
    assert (r.email_rows, r.phone_rows, r.name_rows) == (1, 1, 1)


def test_serving_shift_notes_are_redacted(spark, raw):
    sh = silver.silver_shifts(raw["shifts_raw"]).withColumn(
        "handoff_notes", F.concat(F.col("handoff_notes"), F.lit(" - ask riley QUINN")))
    out = serving.serving_shifts(sh)
    assert out.filter(F.lower("handoff_notes_redacted").contains("riley")).count() == 0
    assert "handoff_notes" not in out.columns


def test_identity_lookup_masks_without_privilege(spark, raw, fx):
    people = silver.work_order_people(raw["work_orders_raw"])
    masked = governance.identity_lookup(fx["work_orders"], people, "work_order_id", "work_order_people", ["plant_PLANT-01"])
    assert {r.technician_name for r in masked.collect()} == {"REDACTED"}
    clear = governance.identity_lookup(fx["work_orders"], people, "work_order_id", "work_order_people", ["pii_readers"])
    assert "Jordan Lee" in {r.technician_name for r in clear.collect()}


def test_pseudonymise_keeps_join_key_consistent(spark, fx):
    a = governance.pseudonymise(fx["work_orders"], ["technician_employee_id"], "s")
    ids = {r.technician_employee_id for r in a.collect()}
    assert len(ids) == 4 and all(len(i) == 64 for i in ids)
