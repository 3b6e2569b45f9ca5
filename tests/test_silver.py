"""Silver split: the reference's Spark cases, plus zone and type variants."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.operators import silver
from tests.plan_util import plan

START, END = datetime(2026, 1, 1), datetime(2026, 2, 1)

SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count long, trip_distance double, fare_amount double, total_amount double, "
    "_source_file string"
)


def rows():
    src = "trips_2026-01.parquet"
    return [
        (1, datetime(2026, 1, 10, 10, 0), datetime(2026, 1, 10, 10, 15), 1, 3.5, 15.0, 18.0, src),
        (1, datetime(2025, 12, 31, 23, 59), datetime(2026, 1, 1, 0, 10), 1, 2.0, 10.0, 12.0, src),
        (2, datetime(2026, 1, 17, 19, 30), datetime(2026, 1, 17, 19, 18), 1, 4.0, 20.0, 24.0, src),
        (2, datetime(2026, 1, 20, 8, 0), datetime(2026, 1, 20, 8, 5), None, 0.0, -5.0, -7.0, src),
    ]


@pytest.fixture
def bronze(utc):
    return utc.createDataFrame(rows(), SCHEMA)


def test_split_counts(bronze):
    s, q = silver.split(bronze, START, END)
    assert (s.count(), q.count()) == (2, 2)
    assert s.count() + q.count() == bronze.count()


def test_quarantine_reasons(bronze):
    _, q = silver.split(bronze, START, END)
    reasons = sorted(r[0] for r in q.select(C.REASON_COLUMN).collect())
    assert reasons == ["dropoff_before_pickup", "pickup_outside_period"]


def test_flags_and_duration(bronze):
    s, _ = silver.split(bronze, START, END)
    row = s.filter(F.col("fare_amount") < 0).first()
    assert row["is_zero_distance"] and row["has_negative_fare"]
    assert row["has_negative_total"] and row["is_passenger_count_null"]
    assert row["trip_duration_minutes"] == 5.0
    ok = s.filter(F.col("fare_amount") > 0).first()
    assert not (ok["is_zero_distance"] or ok["has_negative_fare"] or ok["has_negative_total"])
    assert ok["trip_duration_minutes"] == 15.0


def test_names_lowercased_and_internal_columns_dropped(bronze):
    s, q = silver.split(bronze, START, END)
    assert all(c == c.lower() for c in s.columns)
    assert "vendorid" in s.columns and "VendorID" not in s.columns
    assert not any(c.startswith("_is_") for c in s.columns + q.columns)
    assert C.REASON_COLUMN not in s.columns and C.REASON_COLUMN in q.columns


def test_missing_timestamps_are_quarantined(utc):
    df = utc.createDataFrame(
        [
            (1, None, datetime(2026, 1, 10, 10, 15), 1, 1.0, 1.0, 1.0, "f"),
            (1, datetime(2026, 1, 10, 10, 0), None, 1, 1.0, 1.0, 1.0, "f"),
        ],
        SCHEMA,
    )
    s, q = silver.split(df, START, END)
    assert s.count() == 0
    assert sorted(r[0] for r in q.select(C.REASON_COLUMN).collect()) == [
        "missing_dropoff_datetime", "missing_pickup_datetime"]


def test_two_broken_rules_give_both_reasons(utc):
    df = utc.createDataFrame(
        [(1, datetime(2025, 12, 31, 23, 0), datetime(2025, 12, 31, 22, 0), 1, 1.0, 1.0, 1.0, "f")],
        SCHEMA,
    )
    _, q = silver.split(df, START, END)
    assert q.first()[C.REASON_COLUMN] == "pickup_outside_period;dropoff_before_pickup"


def test_upper_bound_is_exclusive(utc):
    df = utc.createDataFrame(
        [(1, datetime(2026, 2, 1), datetime(2026, 2, 1, 0, 30), 2, 4.0, 20.0, 24.0, "f")], SCHEMA)
    _, q = silver.split(df, START, END)
    assert q.first()[C.REASON_COLUMN] == "pickup_outside_period"


def test_invalid_period(bronze):
    with pytest.raises(ValueError):
        silver.split(bronze, END, START)
    with pytest.raises(ValueError):
        silver.split(bronze, "2026-02-01 00:00:00", "2026-01-01 00:00:00")


@pytest.mark.parametrize("name", ["", "   "])
def test_blank_source_file(bronze, name):
    with pytest.raises(ValueError):
        silver.add_lineage(bronze, name)


def test_lineage_literal(bronze):
    out = silver.add_lineage(bronze.drop("_source_file"), "a.parquet")
    assert [r[0] for r in out.select("_source_file").distinct().collect()] == ["a.parquet"]


def test_name_collision_is_reported(utc):
    df = utc.createDataFrame(
        [(1, 2, datetime(2026, 1, 10), datetime(2026, 1, 10, 1), 1, 1.0, 1.0, 1.0)],
        "VendorID int, vendorid int, tpep_pickup_datetime timestamp, "
        "tpep_dropoff_datetime timestamp, passenger_count long, trip_distance double, "
        "fare_amount double, total_amount double",
    )
    with pytest.raises(ValueError, match="vendorid"):
        silver.split(df, START, END)


def test_ntz_bounds_independent_of_session_zone(spark):
    """NTZ columns are compared with NTZ bounds: same rows in every session zone."""
    data = [(1, datetime(2026, 1, 1, 0, 0), datetime(2026, 1, 1, 0, 30), 1, 1.0, 1.0, 1.0, "f"),
            (1, datetime(2025, 12, 31, 23, 0), datetime(2025, 12, 31, 23, 30), 1, 1.0, 1.0, 1.0, "f")]
    ntz = SCHEMA.replace("timestamp,", "timestamp_ntz,")
    results = []
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame(data, ntz)
        s, q = silver.split(df, "2026-01-01 00:00:00", "2026-02-01 00:00:00")
        results.append((s.count(), q.count()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results == [(1, 1)] * 3


def test_labelled_matches_split(bronze):
    lab = silver.labelled(bronze, START, END)
    s, q = silver.split(bronze, START, END)
    assert lab.filter(F.col("_layer") == "silver").count() == s.count()
    assert lab.filter(F.col("_layer") == "quarantine").count() == q.count()
    assert lab.filter(F.col("_layer").isNull()).count() == 0


def test_split_is_one_scan_and_pushes_nothing_it_should_not(bronze, tmp_path, utc):
    path = str(tmp_path / "b")
    bronze.write.parquet(path)
    s, _ = silver.split(utc.read.parquet(path), START, END)
    text = plan(s)
    assert text.count("FileScan parquet") == 1 and "Exchange" not in text
