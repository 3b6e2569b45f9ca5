"""Data-quality contract: the reference's raw-check cases and the silver/mart checks."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.operators import checks, profile

RAW_SCHEMA = (
    "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count long, trip_distance double, PULocationID long, DOLocationID long, "
    "payment_type long, fare_amount double, total_amount double"
)
START, END = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def raw(spark, **overrides):
    base = dict(VendorID=1, tpep_pickup_datetime=datetime(2026, 1, 10, 10),
                tpep_dropoff_datetime=datetime(2026, 1, 10, 10, 20), passenger_count=1,
                trip_distance=2.5, PULocationID=1, DOLocationID=2, payment_type=1,
                fare_amount=15.0, total_amount=18.0)
    base.update(overrides)
    names = [f.split()[0] for f in RAW_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(base[n] for n in names)], RAW_SCHEMA)


def report(df):
    return {r["name"]: r.asDict() for r in checks.check_raw(df, START, END).collect()}


def test_valid_row_passes(utc):
    rep = report(raw(utc))
    assert all(r["status"] == C.PASS for r in rep.values())
    assert len(rep) == 1 + 8 + 6
    assert checks.verdict(checks.check_raw(raw(utc), START, END)).first()["passed"]


def test_anomalous_row_passes_with_four_warnings(utc):
    df = raw(utc, passenger_count=None, trip_distance=0.0, fare_amount=-10.0, total_amount=-12.0)
    rep = report(df)
    warned = sorted(n for n, r in rep.items() if r["status"] == C.WARN)
    assert warned == sorted([C.PASSENGER_COUNT_NULL, C.TRIP_DISTANCE_ZERO,
                             C.NEGATIVE_FARE_AMOUNT, C.NEGATIVE_TOTAL_AMOUNT])
    v = checks.verdict(checks.check_raw(df, START, END)).first()
    assert v["passed"] and v["blocking_failures"] == 0


def test_missing_required_column_stops_before_scan(utc):
    df = raw(utc).drop("VendorID")
    out = checks.check_raw(df, START, END)
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["name"] == C.REQUIRED_COLUMNS_RULE
    assert rows[0]["status"] == C.FAIL and rows[0]["observed"] == 1
    assert not checks.verdict(out).first()["passed"]


def test_null_critical_column_fails(utc):
    df = raw(utc, tpep_pickup_datetime=None)
    rep = report(df)
    assert rep["null_tpep_pickup_datetime"]["status"] == C.FAIL
    v = checks.verdict(checks.check_raw(df, START, END)).first()
    assert not v["passed"] and v["blocking_failures"] == 1


def test_fare_is_required_but_not_null_checked(utc):
    rep = report(raw(utc, fare_amount=None))
    assert "null_fare_amount" not in rep
    assert all(r["status"] == C.PASS for r in rep.values())


def test_absent_optional_column_is_a_warning_not_a_crash(utc):
    rep = report(raw(utc).drop("passenger_count"))
    assert rep[C.PASSENGER_COUNT_NULL]["status"] == C.WARN
    assert rep[C.PASSENGER_COUNT_NULL]["observed"] is None


def test_outside_period_is_warning_in_raw(utc):
    rep = report(raw(utc, tpep_pickup_datetime=datetime(2025, 12, 31, 23)))
    assert rep[C.PICKUP_OUTSIDE_PERIOD]["status"] == C.WARN


def test_rules_evaluated_in_one_scan(utc, tmp_path):
    path = str(tmp_path / "raw")
    raw(utc).write.parquet(path)
    from tests.plan_util import plan
    text = plan(checks.check_raw(utc.read.parquet(path), START, END))
    assert text.count("FileScan parquet") == 1


def _silver(spark, **kw):
    from strata.operators import silver
    s, q = silver.split(silver.add_lineage(raw(spark, **kw), "f.parquet"), START, END)
    return s, q


def test_silver_checks_pass_and_reconcile(utc):
    s, q = _silver(utc)
    rep = checks.check_silver(raw(utc), s, q, START, END)
    rows = {r["name"]: r for r in rep.collect()}
    assert set(rows) == {C.RECONCILIATION, C.SILVER_SCHEMA, C.DROPOFF_BEFORE_PICKUP,
                         C.PICKUP_OUTSIDE_PERIOD}
    assert all(r["passed"] for r in rows.values())
    assert checks.silver_verdict(rep).first()["passed"]


def test_silver_reconciliation_failure(utc):
    s, q = _silver(utc)
    rep = checks.check_silver(raw(utc).union(raw(utc)), s, q, START, END)
    rows = {r["name"]: r for r in rep.collect()}
    assert not rows[C.RECONCILIATION]["passed"] and rows[C.RECONCILIATION]["observed"] == 1
    assert not checks.silver_verdict(rep).first()["passed"]


def test_silver_schema_failure_reports_temporal_rules_as_failed(utc):
    s, q = _silver(utc)
    rep = checks.check_silver(raw(utc), s.drop("tpep_pickup_datetime"), q, START, END)
    rows = {r["name"]: r for r in rep.collect()}
    assert not rows[C.SILVER_SCHEMA]["passed"]
    assert not rows[C.DROPOFF_BEFORE_PICKUP]["passed"]


def test_not_null_unique_and_reconcile(utc):
    daily = utc.createDataFrame([(date(2026, 1, 1), 2), (date(2026, 1, 1), 3), (None, 1)],
                                "pickup_date date, trip_count long")
    assert checks.duplicate_keys(daily, ["pickup_date"]).count() == 1
    assert checks.not_null_failures(daily, ["pickup_date"]).count() == 1
    summary = checks.not_null_summary("m", daily, ["pickup_date", "trip_count"]).collect()
    assert [(r["column_name"], r["null_count"]) for r in summary] == [("pickup_date", 1), ("trip_count", 0)]
    stg = utc.range(6)
    assert checks.mart_reconciles(stg, daily).first()["passed"]
    assert checks.mart_reconcile_failures(stg, daily).count() == 0
    assert checks.mart_reconcile_failures(utc.range(5), daily).count() == 1


def test_empty_mart_does_not_pass_vacuously(utc):
    empty = utc.createDataFrame([], "pickup_date date, trip_count long")
    assert not checks.mart_reconciles(utc.range(3), empty).first()["passed"]


def test_profile_nulls_on_empty_table(utc):
    empty = raw(utc).filter(F.lit(False))
    rows = profile.null_profile(empty, ["VendorID"]).collect()
    assert rows[0]["null_count"] == 0 and rows[0]["null_percent"] == 0.0


def test_profile_rules(utc):
    df = raw(utc, trip_distance=-1.0, fare_amount=-1.0)
    got = {r["rule"]: r["row_count"] for r in profile.rule_profile(df).collect()}
    assert got["trip_distance_negative"] == 1 and got["fare_amount_negative"] == 1
    assert got["trip_distance_zero"] == 0 and got["dropoff_before_pickup"] == 0


@pytest.mark.parametrize("severity,passed,expected", [
    (C.FAIL, True, C.PASS), (C.FAIL, False, C.FAIL), (C.WARN, False, C.WARN)])
def test_status(utc, severity, passed, expected):
    df = utc.createDataFrame([(severity, passed)], "severity string, passed boolean")
    assert df.select(checks.status(F.col("passed"), F.col("severity"))).first()[0] == expected


def test_evaluate_without_rules_is_empty(utc):
    out = checks.evaluate(raw(utc), [])
    assert out.count() == 0 and out.columns == [f.name for f in checks.RESULT_SCHEMA.fields]
