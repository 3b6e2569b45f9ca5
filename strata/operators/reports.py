"""Run reports: layer counts, silver metrics, checkpoint, reasons, gold check."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.functions import predicates as P
from strata.functions.measures import count_flag
from strata.operators.silver import LAYER_COLUMN, QUARANTINE, SILVER


def layer_counts_one_pass(labelled: DataFrame) -> DataFrame:
    """Bronze, silver and quarantine counts from one scan of the labelled split."""
    layer = F.col(LAYER_COLUMN)
    return labelled.agg(
        F.count(F.lit(1)).alias("bronze_count"),
        F.count_if(layer == F.lit(SILVER)).alias("silver_count"),
        F.count_if(layer == F.lit(QUARANTINE)).alias("quarantine_count"),
    )


def silver_metrics(
    silver: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
) -> DataFrame:
    """Silver rows plus the two blocking and four flag counts (0 on empty input)."""
    pick, drop = C.PICKUP.lower(), C.DROPOFF.lower()
    ptype = P.column_type(silver, pick)
    start, end = P.ts_bound(period_start, ptype), P.ts_bound(period_end, ptype)
    p = F.col(pick)
    return silver.agg(
        F.count(F.lit(1)).alias("silver_count"),
        P.count_true((p < start) | (p >= end)).alias("pickup_outside_period"),
        P.count_true(F.col(drop) < p).alias("dropoff_before_pickup"),
        count_flag(C.IS_ZERO_DISTANCE).alias("zero_distance_rows"),
        count_flag(C.HAS_NEGATIVE_FARE).alias("negative_fare_rows"),
        count_flag(C.HAS_NEGATIVE_TOTAL).alias("negative_total_rows"),
        count_flag(C.IS_PASSENGER_COUNT_NULL).alias("passenger_count_null_rows"),
    )


def checkpoint_report(
    bronze: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
) -> DataFrame:
    """One row: three counts, ``reconciled`` and the six silver issue counts.

    The three inputs are stacked (a narrow union) and counted by a single
    aggregate; bronze and quarantine contribute no data columns.
    """
    from strata.operators.checks import tagged_union

    pick, drop = C.PICKUP.lower(), C.DROPOFF.lower()
    ptype = P.column_type(silver, pick)
    start, end = P.ts_bound(period_start, ptype), P.ts_bound(period_end, ptype)
    p = F.col(pick)
    s = silver.select(
        ((p < start) | (p >= end)).alias("_outside"),
        (F.col(drop) < p).alias("_before"),
        *[F.col(c) for c in (C.IS_ZERO_DISTANCE, C.HAS_NEGATIVE_FARE, C.HAS_NEGATIVE_TOTAL,
                             C.IS_PASSENGER_COUNT_NULL)],
    )
    u = tagged_union(bronze=bronze.select(), silver=s, quarantine=quarantine.select())
    counts = u.agg(
        F.count("_bronze").alias("bronze_count"),
        F.count("_silver").alias("silver_count"),
        F.count("_quarantine").alias("quarantine_count"),
        P.count_true(F.col("_outside")).alias("pickup_outside_period"),
        P.count_true(F.col("_before")).alias("dropoff_before_pickup"),
        count_flag(C.IS_ZERO_DISTANCE).alias("zero_distance_rows"),
        count_flag(C.HAS_NEGATIVE_FARE).alias("negative_fare_rows"),
        count_flag(C.HAS_NEGATIVE_TOTAL).alias("negative_total_rows"),
        count_flag(C.IS_PASSENGER_COUNT_NULL).alias("passenger_count_null_rows"),
    )
    return counts.select(
        "bronze_count",
        "silver_count",
        "quarantine_count",
        (F.col("bronze_count") == F.col("silver_count") + F.col("quarantine_count")).alias(
            "reconciled"
        ),
        "pickup_outside_period",
        "dropoff_before_pickup",
        "zero_distance_rows",
        "negative_fare_rows",
        "negative_total_rows",
        "passenger_count_null_rows",
    )


def checkpoint_from_split(labelled: DataFrame, period_start: datetime | date | str,
                          period_end: datetime | date | str) -> DataFrame:
    """The checkpoint report from ONE scan: the split's rows with their layer."""
    pick, drop = F.col(C.PICKUP.lower()), F.col(C.DROPOFF.lower())
    ptype = P.column_type(labelled, C.PICKUP.lower())
    start, end = P.ts_bound(period_start, ptype), P.ts_bound(period_end, ptype)
    kept = F.col(LAYER_COLUMN) == F.lit(SILVER)
    flags = {"zero_distance_rows": C.IS_ZERO_DISTANCE, "negative_fare_rows": C.HAS_NEGATIVE_FARE,
             "negative_total_rows": C.HAS_NEGATIVE_TOTAL,
             "passenger_count_null_rows": C.IS_PASSENGER_COUNT_NULL}
    counts = labelled.agg(
        F.count(F.lit(1)).alias("bronze_count"),
        F.count_if(kept).alias("silver_count"),
        F.count_if(F.col(LAYER_COLUMN) == F.lit(QUARANTINE)).alias("quarantine_count"),
        P.count_true(kept & ((pick < start) | (pick >= end))).alias("pickup_outside_period"),
        P.count_true(kept & (drop < pick)).alias("dropoff_before_pickup"),
        *[P.count_true(kept & F.col(c)).alias(name) for name, c in flags.items()],
    )
    matches = F.col("bronze_count") == F.col("silver_count") + F.col("quarantine_count")
    return counts.select("bronze_count", "silver_count", "quarantine_count", matches.alias("reconciled"),
                         "pickup_outside_period", "dropoff_before_pickup", *flags)


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per reason, ordered by reason."""
    return (
        quarantine.groupBy(C.REASON_COLUMN)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(C.REASON_COLUMN)
    )


def validate_gold(daily: DataFrame) -> DataFrame:
    """Roll-up check of the daily mart: days, trips, date range, issue totals."""
    return daily.agg(
        F.count(F.lit(1)).alias("day_count"),
        F.sum("trip_count").alias("total_trip_count"),
        F.min("pickup_date").alias("min_pickup_date"),
        F.max("pickup_date").alias("max_pickup_date"),
        F.sum("zero_distance_trip_count").alias("zero_distance_trip_count"),
        F.sum("negative_fare_trip_count").alias("negative_fare_trip_count"),
        F.sum("negative_total_trip_count").alias("negative_total_trip_count"),
        F.sum("missing_passenger_count_trip_count").alias("missing_passenger_count_trip_count"),
    )
