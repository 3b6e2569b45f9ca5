"""Properties the reference does not test: the split partitions bronze, roll-ups
reconcile, and results do not depend on input partitioning or session zone."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.measures import exact_average, exact_sum
from strata.functions.names import lowercase_columns
from strata.operators import marts, silver
from strata.plans import layers as L
from tests.conftest import SF_SMALL

SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count long, trip_distance double, fare_amount double, total_amount double, "
    "PULocationID int, DOLocationID int, payment_type long"
)
BASE = datetime(2026, 1, 1)
START, END = "2026-01-01 00:00:00", "2026-02-01 00:00:00"

ts = st.one_of(st.none(), st.integers(-3 * 24 * 60, 34 * 24 * 60).map(
    lambda m: BASE + timedelta(minutes=m)))
money = st.integers(-5000, 5000).map(lambda c: c / 100)
row = st.tuples(st.integers(1, 3), ts, ts, st.one_of(st.none(), st.integers(0, 6)),
                st.integers(0, 300).map(lambda d: d / 10), money, money,
                st.integers(1, 265), st.integers(1, 265), st.integers(1, 4))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_split_partitions_bronze(spark, rows):
    bronze = silver.add_lineage(spark.createDataFrame(rows, SCHEMA), "f")
    s, q = silver.split(bronze, START, END)
    lab = silver.labelled(bronze, START, END)
    assert s.count() + q.count() == len(rows)
    assert lab.filter(F.col("_layer").isNull()).count() == 0
    key = ["vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
           "trip_distance", "fare_amount", "total_amount"]
    both = sorted(s.select(key).collect() + q.select(key).collect(), key=repr)
    assert both == sorted(lowercase_columns(bronze).select(key).collect(), key=repr)
    assert s.filter(F.col("tpep_pickup_datetime").isNull()
                    | (F.col("tpep_dropoff_datetime") < F.col("tpep_pickup_datetime"))).count() == 0
    daily = marts.daily_mart(marts.enrich(marts.stage(s)))
    assert (daily.agg(F.sum("trip_count")).first()[0] or 0) == s.count()


def test_monthly_equals_regrouped_daily(spark):
    daily = L.daily(spark, SF_SMALL)
    monthly = {r["pickup_month"]: r for r in marts.monthly_mart(daily).collect()}
    regrouped = (daily.groupBy(F.trunc("pickup_date", "month").alias("m"))
                 .agg(F.sum("trip_count").alias("n")).collect())
    assert {r["m"]: r["n"] for r in regrouped} == {k: v["total_trips"] for k, v in monthly.items()}


def test_results_do_not_depend_on_partitioning(spark):
    bronze = L.bronze(spark, SF_SMALL)
    a = marts.daily_mart(marts.enrich(marts.stage(silver.split(
        bronze, L.fixtures.PERIOD_START, L.fixtures.PERIOD_END)[0])))
    for parts in (4, 64):
        b = marts.daily_mart(marts.enrich(marts.stage(silver.split(
            bronze.repartition(parts), L.fixtures.PERIOD_START, L.fixtures.PERIOD_END)[0])))
        assert sorted(a.collect()) == sorted(b.collect())


def test_sums_are_those_of_fractions(spark):
    r = random.Random(1)
    values = [r.choice((-1, 1)) * r.uniform(0.1, 1) * 10.0 ** r.randint(-9, 12) for _ in range(2000)] + [0.1] * 10 + [-0.0, 1e17, -1e17]
    for some in (values, values[:7], [0.1, 0.2, -0.3], [-1e-9], [5.0], [2.0 ** 61, -0.5]):
        df = spark.createDataFrame([(v,) for v in some] + [(None,)], "x double")
        for parts in (1, 16):
            total, mean = df.repartition(parts).agg(exact_sum("x"), exact_average("x")).first()
            exact = float(sum(map(Fraction, some)))
            # the double nearest the exact sum, or its neighbour where the last digit is a tie
            assert total == exact or abs(total - exact) <= math.ulp(exact)
            assert mean == total / len(some)
        assert len({df.repartition(n).agg(exact_sum("x")).first()[0] for n in (1, 4, 64)}) == 1
    assert spark.createDataFrame([(None,)], "x double").agg(exact_sum("x"), exact_average("x")).first() == (None, None)


@pytest.mark.parametrize("value", [1e-30, 1e19, float("nan"), float("inf")])
def test_what_cannot_be_added_exactly_raises(spark, value):
    with pytest.raises(Exception, match="too large or too fine"):
        spark.createDataFrame([(value,), (1.0,)], "x double").agg(exact_sum("x")).collect()


def test_results_do_not_depend_on_session_zone(spark):
    results = []
    for zone in ("UTC", "Asia/Tokyo", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        results.append((sorted(L.daily(spark, SF_SMALL).collect()),
                        sorted(L.enriched(spark, SF_SMALL).collect(), key=repr)))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]
