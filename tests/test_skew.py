"""A hot key holding a third of the rows: the join splits it, aggregates pre-combine it."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import joins, marts
from tests.plan_util import plan


def _skewed_fact(spark, n=300_000):
    # one zone (id 1) gets a third of all trips
    zone = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 264 + 2).cast("int"))
    return spark.range(n).select(zone.cast("int").alias("pickup_location_id"),
                                 (F.col("id") % 100).cast("double").alias("total_amount"))


def test_salt_spreads_a_hot_zone_and_equally_heavy_zones(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        hot = _skewed_fact(spark)
        even = hot.withColumn("pickup_location_id", F.lit(1) + (F.rand(1) * 3).cast("int"))
        for fact, most in ((hot, 0.1), (even, 0.1)):
            out = joins.zone_join(fact, joins.zone_dim(spark), "merge")
            assert "SortMergeJoin" in plan(out)
            sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
            assert sum(sizes) == 300_000 and max(sizes) < most * 300_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_day_is_combined_before_the_shuffle(spark):
    df = _skewed_fact(spark).select(
        F.when(F.col("pickup_location_id") == 1, F.lit("2026-01-01"))
        .otherwise(F.lit("2026-01-02")).cast("date").alias("pickup_date"),
        F.lit(1).cast("int").alias("passenger_count"),
        F.lit(1.0).alias("trip_distance_miles"),
        F.lit(1.0).alias("trip_duration_minutes"),
        F.lit(1.0).alias("fare_amount"),
        F.col("total_amount"),
        F.lit(False).alias("is_zero_distance"), F.lit(False).alias("has_negative_fare"),
        F.lit(False).alias("has_negative_total"), F.lit(False).alias("is_passenger_count_null"),
    )
    daily = marts.daily_mart(df)
    text = plan(daily)
    # partial aggregate before the exchange: at most (days x tasks) rows are shuffled
    assert text.index("HashAggregate") < text.index("Exchange")
    rows = {r["pickup_date"].isoformat(): r["trip_count"] for r in daily.collect()}
    assert rows == {"2026-01-01": 100_000, "2026-01-02": 200_000}
