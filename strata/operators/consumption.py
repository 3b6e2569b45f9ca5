"""Dashboard and BI queries over the marts (all small: the marts are per day/month)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.measures import exact_average, exact_sum


def monthly_kpis(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "pickup_month", "total_trips", "total_amount", "total_distance_miles",
        "average_amount_per_trip",
    ).orderBy("pickup_month")


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select("pickup_date", "trip_count", "average_amount_per_trip").orderBy(
        "pickup_date"
    )


def quality_by_month(quality: DataFrame) -> DataFrame:
    return quality.select("pickup_month", "quality_issue", "sort_order", "issue_count").orderBy(
        F.col("pickup_month"), F.col("issue_count").desc(), F.col("sort_order")
    )


def total_trips(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.sum("total_trips").alias("total_trips"))


def total_amount(monthly: DataFrame) -> DataFrame:
    return monthly.agg(exact_sum("total_amount", endless=True).alias("total_amount"))


def total_distance(monthly: DataFrame) -> DataFrame:
    return monthly.agg(exact_sum("total_distance_miles", endless=True).alias("total_distance_miles"))


def average_amount_for_month(monthly: DataFrame, month: date | str) -> DataFrame:
    """Average amount per trip of one month.

    A ``MAX`` over the per-month ratio is only meaningful for a single month,
    so the month is an argument rather than a dashboard-wide filter.
    """
    m = F.to_date(F.lit(str(month)))
    return monthly.filter(F.col("pickup_month") == m).agg(
        F.max("average_amount_per_trip").alias("average_amount_per_trip")
    )


def daily_trips(daily: DataFrame) -> DataFrame:
    return daily.groupBy("pickup_date").agg(F.sum("trip_count").alias("trip_count"))


def daily_average_amount(daily: DataFrame) -> DataFrame:
    """``AVG`` of the per-day ratio by day (one row per day, so the value itself)."""
    day = F.to_date(F.date_trunc("DAY", F.col("pickup_date").cast("timestamp_ntz")))
    return daily.groupBy(day.alias("pickup_day")).agg(
        exact_average("average_amount_per_trip", endless=True).alias("average_amount_per_trip")
    )


def quality_issues(quality: DataFrame) -> DataFrame:
    return quality.select("quality_issue", "issue_count").orderBy(F.col("issue_count").desc())


def mart_row_counts(daily: DataFrame, monthly: DataFrame, quality: DataFrame) -> DataFrame:
    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("row_count"))

    return (
        count("mart_daily_trip_metrics", daily)
        .unionByName(count("mart_monthly_trip_kpis", monthly))
        .unionByName(count("mart_data_quality_summary", quality))
    )
