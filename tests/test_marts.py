"""Gold marts on the reference's three-row silver fixture (hand-computed values)."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import consumption, marts

SILVER_SCHEMA = (
    "vendorid long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count long, trip_distance double, pulocationid long, dolocationid long, "
    "payment_type long, fare_amount double, total_amount double, trip_duration_minutes double, "
    "is_zero_distance boolean, has_negative_fare boolean, has_negative_total boolean, "
    "is_passenger_count_null boolean, _source_file string"
)


@pytest.fixture
def silver_df(utc):
    f = "fixture.parquet"
    return utc.createDataFrame(
        [
            (1, datetime(2026, 1, 10, 8), datetime(2026, 1, 10, 8, 20), 1, 2.5, 1, 2, 1, 15.0, 18.0,
             20.0, False, False, False, False, f),
            (2, datetime(2026, 1, 10, 9), datetime(2026, 1, 10, 9, 30), 2, 4.0, 3, 4, 1, 20.0, 24.0,
             30.0, False, False, False, False, f),
            (1, datetime(2026, 1, 11, 23), datetime(2026, 1, 11, 23, 15), None, 0.0, 5, 6, 2, 8.0,
             10.0, 15.0, True, False, False, True, f),
        ],
        SILVER_SCHEMA,
    )


def test_daily_mart_values(silver_df):
    daily = marts.daily_mart(marts.enrich(marts.stage(silver_df)))
    got = {r["pickup_date"]: r.asDict() for r in daily.collect()}
    d10, d11 = got[date(2026, 1, 10)], got[date(2026, 1, 11)]
    assert (d10["trip_count"], d10["trips_with_passenger_count"], d10["known_passenger_count"]) == (2, 2, 3)
    assert (d10["total_distance_miles"], d10["average_trip_distance_miles"]) == (6.5, 3.25)
    assert d10["average_trip_duration_minutes"] == 25.0
    assert (d10["total_fare_amount"], d10["total_amount"], d10["average_amount_per_trip"]) == (35.0, 42.0, 21.0)
    assert (d10["zero_distance_trip_count"], d10["missing_passenger_count_trip_count"]) == (0, 0)
    assert (d11["trip_count"], d11["trips_with_passenger_count"], d11["known_passenger_count"]) == (1, 0, None)
    assert (d11["total_distance_miles"], d11["average_trip_distance_miles"]) == (0.0, 0.0)
    assert (d11["average_trip_duration_minutes"], d11["average_amount_per_trip"]) == (15.0, 10.0)
    assert (d11["zero_distance_trip_count"], d11["missing_passenger_count_trip_count"]) == (1, 1)
    assert (d11["negative_fare_trip_count"], d11["negative_total_trip_count"]) == (0, 0)


def test_monthly_and_quality(silver_df):
    daily = marts.daily_mart(marts.enrich(marts.stage(silver_df)))
    m = marts.monthly_mart(daily).first()
    assert m["pickup_month"] == date(2026, 1, 1)
    assert (m["total_trips"], m["total_amount"], m["total_distance_miles"]) == (3, 52.0, 6.5)
    assert m["average_amount_per_trip"] == pytest.approx(52.0 / 3)
    q = {r["quality_issue"]: (r["sort_order"], r["issue_count"]) for r in marts.quality_mart(daily).collect()}
    assert q == {"Missing passenger count": (1, 1), "Zero distance": (2, 1),
                 "Negative total amount": (3, 0), "Negative fare": (4, 0)}


def test_speeds(silver_df):
    enr = marts.enrich(marts.stage(silver_df)).orderBy("pickup_at")
    assert [r["average_speed_mph"] for r in enr.collect()] == [7.5, 8.0, None]
    assert [r["pickup_hour"] for r in enr.collect()] == [8, 9, 23]


def test_staging_contract(silver_df):
    stg = marts.stage(silver_df.withColumn("tip_amount", F.lit(1.0)))
    assert "tip_amount" not in stg.columns
    assert dict(stg.dtypes)["vendor_id"] == "int" and dict(stg.dtypes)["passenger_count"] == "int"
    assert len(stg.columns) == 16


def test_quality_union_equals_unpivot(silver_df):
    daily = marts.daily_mart(marts.enrich(marts.stage(silver_df)))
    a = sorted(marts.quality_mart(daily).collect())
    b = sorted(marts.quality_mart_union(daily).collect())
    assert a == b


def test_ratio_guard_on_zero_duration(utc):
    stg = utc.createDataFrame(
        [(datetime(2026, 1, 1), 0.0, 3.0)], "pickup_at timestamp_ntz, trip_duration_minutes double, "
        "trip_distance_miles double")
    assert marts.enrich(stg).first()["average_speed_mph"] is None


def test_dashboard_counters(silver_df):
    daily = marts.daily_mart(marts.enrich(marts.stage(silver_df)))
    monthly = marts.monthly_mart(daily)
    assert consumption.total_trips(monthly).first()[0] == 3
    assert consumption.total_amount(monthly).first()[0] == 52.0
    assert consumption.average_amount_for_month(monthly, "2026-01-01").first()[0] == pytest.approx(52 / 3)
    assert consumption.average_amount_for_month(monthly, "2026-02-01").first()[0] is None
    counts = {r["mart"]: r["row_count"] for r in consumption.mart_row_counts(
        daily, monthly, marts.quality_mart(daily)).collect()}
    assert counts == {"mart_daily_trip_metrics": 2, "mart_monthly_trip_kpis": 1,
                      "mart_data_quality_summary": 4}


def test_measures_are_not_cut_before_they_are_added(utc):
    rows = [(datetime(2026, 1, 1, 0, 0, 0), 1 / 3, 0.00004, 0.00004, 1e15)] * 10
    df = utc.createDataFrame(rows, "pickup_at timestamp_ntz, trip_duration_minutes double, "
                             "trip_distance_miles double, fare_amount double, total_amount double")
    flags = {c: F.lit(False) for c in ("is_zero_distance", "has_negative_fare", "has_negative_total",
                                       "is_passenger_count_null")}
    enriched = marts.enrich(df).withColumns({**flags, "passenger_count": F.lit(1)})
    got = marts.daily_mart(enriched).first()
    assert got["total_distance_miles"] == pytest.approx(0.0004)
    assert got["total_amount"] == pytest.approx(1e16)
    assert got["average_trip_duration_minutes"] == pytest.approx(1 / 3)
    nan = enriched.withColumn("fare_amount", F.lit(float("nan")))
    assert str(marts.daily_mart(nan).first()["total_fare_amount"]) == "nan"
