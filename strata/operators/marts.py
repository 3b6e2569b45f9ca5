"""Gold layer: typed staging, enrichment and the daily, monthly and quality marts.

Each function is ``DataFrame -> DataFrame``. The daily mart is the only one
that aggregates the fact table (partial + final hash aggregate, one shuffle of
at most days x map tasks rows, so a hot day does not skew it); the monthly and
quality marts roll up the small daily result instead of rescanning trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.functions import measures as M
from strata.functions.predicates import safe_ratio

# Staging contract: (output name, silver column, cast type or None for as-is).
STAGING_COLUMNS = (
    ("vendor_id", "vendorid", "int"),
    ("pickup_at", "tpep_pickup_datetime", None),
    ("dropoff_at", "tpep_dropoff_datetime", None),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance_miles", "trip_distance", "double"),
    ("pickup_location_id", "pulocationid", "int"),
    ("dropoff_location_id", "dolocationid", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("total_amount", "total_amount", "double"),
    ("trip_duration_minutes", "trip_duration_minutes", "double"),
    ("is_zero_distance", "is_zero_distance", "boolean"),
    ("has_negative_fare", "has_negative_fare", "boolean"),
    ("has_negative_total", "has_negative_total", "boolean"),
    ("is_passenger_count_null", "is_passenger_count_null", "boolean"),
    ("_source_file", "_source_file", None),
)


def stage(silver: DataFrame) -> DataFrame:
    """Rename to business names, cast to fixed types, drop every other column."""
    out = []
    for name, source, cast in STAGING_COLUMNS:
        c = F.col(source)
        out.append((c.cast(cast) if cast else c).alias(name))
    return silver.select(*out)


def enrich(staged: DataFrame) -> DataFrame:
    """Add ``pickup_date``, ``pickup_hour`` and a guarded ``average_speed_mph``."""
    minutes = F.col("trip_duration_minutes")
    miles = F.col("trip_distance_miles")
    return staged.select(
        "*",
        F.to_date("pickup_at").alias("pickup_date"),
        F.hour("pickup_at").alias("pickup_hour"),
        F.when((minutes > 0) & (miles > 0), miles / (minutes / F.lit(60.0))).alias(
            "average_speed_mph"
        ),
    )


def daily_mart(enriched: DataFrame) -> DataFrame:
    """One row per ``pickup_date`` with 13 measures."""
    trips = F.count(F.lit(1))
    measured = M.with_parts(enriched, ("trip_distance_miles", "trip_duration_minutes", "fare_amount", "total_amount"))
    return measured.groupBy("pickup_date").agg(
        trips.alias("trip_count"),
        F.count("passenger_count").alias("trips_with_passenger_count"),
        F.sum(F.col("passenger_count").cast("bigint")).alias("known_passenger_count"),
        M.exact_sum("trip_distance_miles", ready=True, endless=True).alias("total_distance_miles"),
        M.exact_average("trip_distance_miles", ready=True, endless=True).alias("average_trip_distance_miles"),
        M.exact_average("trip_duration_minutes", ready=True, endless=True).alias("average_trip_duration_minutes"),
        M.exact_sum("fare_amount", ready=True, endless=True).alias("total_fare_amount"),
        M.exact_sum("total_amount", ready=True, endless=True).alias("total_amount"),
        safe_ratio(M.exact_sum("total_amount", ready=True, endless=True), trips.cast("double")).alias(
            "average_amount_per_trip"
        ),
        M.count_flag("is_zero_distance").alias("zero_distance_trip_count"),
        M.count_flag("has_negative_fare").alias("negative_fare_trip_count"),
        M.count_flag("has_negative_total").alias("negative_total_trip_count"),
        M.count_flag("is_passenger_count_null").alias("missing_passenger_count_trip_count"),
    )


def pickup_month(date_col: str = "pickup_date"):
    return F.trunc(F.col(date_col), "month").alias("pickup_month")


def monthly_mart(daily: DataFrame) -> DataFrame:
    """Monthly KPIs rolled up from the daily mart; the ratio is recomputed."""
    trips = F.sum("trip_count")
    amount = M.exact_sum("total_amount", endless=True)
    return daily.groupBy(pickup_month()).agg(
        trips.alias("total_trips"),
        amount.alias("total_amount"),
        M.exact_sum("total_distance_miles", endless=True).alias("total_distance_miles"),
        safe_ratio(amount, trips.cast("double")).alias("average_amount_per_trip"),
    )


def _issue_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy(pickup_month()).agg(
        *[F.sum(col).alias(col) for _, _, col in C.QUALITY_ISSUES]
    )


def quality_mart(daily: DataFrame) -> DataFrame:
    """Per month, one row per quality issue with its label, sort order and count.

    One aggregate, then the four measures are turned into rows with a
    generator, instead of four scans of the daily mart joined by UNION ALL.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("quality_issue"),
                F.lit(order).alias("sort_order"),
                M.zero_if_null(F.col(col)).alias("issue_count"),
            )
            for label, order, col in C.QUALITY_ISSUES
        ]
    )
    return _issue_totals(daily).select("pickup_month", F.inline(rows))


def quality_mart_union(daily: DataFrame) -> DataFrame:
    """The same summary written as a UNION ALL of four aggregates (cross-check)."""
    parts = [
        daily.groupBy(pickup_month()).agg(
            F.lit(label).alias("quality_issue"),
            F.lit(order).alias("sort_order"),
            M.zero_if_null(F.sum(col)).alias("issue_count"),
        )
        for label, order, col in C.QUALITY_ISSUES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def daily_study(
    trips: DataFrame,
    period_start: str,
    period_end: str,
    pickup: str = C.PICKUP,
    dropoff: str = C.DROPOFF,
    distance: str = C.DISTANCE,
) -> DataFrame:
    """Count, total distance and average duration per pickup day of a period.

    Only the period filter is applied (no quarantine step). The bounds are
    strings that Spark casts to the column type, and the bare column on the
    left lets the range reach the scan as pushed filters.
    """
    from strata.functions.predicates import duration_minutes

    c = F.col(pickup)
    days = (
        trips.select(pickup, dropoff, distance)
        .filter((c >= F.lit(period_start)) & (c < F.lit(period_end)))
        .select(
            F.to_date(pickup).alias("pickup_date"),
            F.col(distance),
            duration_minutes(pickup, dropoff).alias("trip_duration_minutes"),
        )
    )
    return M.with_parts(days, (distance, "trip_duration_minutes")).groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("trip_count"),
        M.exact_sum(distance, ready=True, endless=True).alias("total_distance"),
        M.exact_average("trip_duration_minutes", ready=True, endless=True).alias("avg_duration_minutes"),
    )
