"""DuckDB texts of the fixture layers, used as CTEs by every oracle query.

These restate the silver rules, staging casts and marts in plain SQL over the
registered driver tables. Sums and averages are plain; a query that returns
them rounds them in its last step, on both sides.
"""

from __future__ import annotations

from strata.functions import contract as C
from strata.plans.fixtures import PERIOD_END, PERIOD_START, SOURCE_FILE, TRIPS_DUCKDB

RAW = TRIPS_DUCKDB

BRONZE = f"SELECT *, '{SOURCE_FILE}' AS _source_file FROM raw"

RULED = f"""
SELECT *,
  tpep_pickup_datetime IS NULL AS r_missing_pickup,
  tpep_dropoff_datetime IS NULL AS r_missing_dropoff,
  COALESCE(tpep_pickup_datetime IS NOT NULL
           AND (tpep_pickup_datetime < TIMESTAMP '{PERIOD_START}'
                OR tpep_pickup_datetime >= TIMESTAMP '{PERIOD_END}'), false) AS r_outside,
  COALESCE(tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
           AND tpep_dropoff_datetime < tpep_pickup_datetime, false) AS r_before,
  datesub('second', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60.0 AS DOUBLE)
      AS trip_duration_minutes,
  trip_distance = 0 AS is_zero_distance,
  fare_amount < 0 AS has_negative_fare,
  total_amount < 0 AS has_negative_total,
  passenger_count IS NULL AS is_passenger_count_null
FROM bronze
"""

_SILVER_COLS = """
  "VendorID" AS vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, "PULocationID" AS pulocationid, "DOLocationID" AS dolocationid, payment_type,
  fare_amount, total_amount, _source_file, trip_duration_minutes, is_zero_distance,
  has_negative_fare, has_negative_total, is_passenger_count_null
"""

SILVER = f"""
SELECT {_SILVER_COLS} FROM ruled
WHERE NOT (r_missing_pickup OR r_missing_dropoff OR r_outside OR r_before)
"""

REASON = """concat_ws(';',
    CASE WHEN r_missing_pickup THEN 'missing_pickup_datetime' END,
    CASE WHEN r_missing_dropoff THEN 'missing_dropoff_datetime' END,
    CASE WHEN r_outside THEN 'pickup_outside_period' END,
    CASE WHEN r_before THEN 'dropoff_before_pickup' END)"""

QUARANTINE = f"""
SELECT {_SILVER_COLS}, {REASON} AS _quarantine_reason FROM ruled
WHERE r_missing_pickup OR r_missing_dropoff OR r_outside OR r_before
"""

STG = """
SELECT CAST(vendorid AS INTEGER) AS vendor_id,
       tpep_pickup_datetime AS pickup_at,
       tpep_dropoff_datetime AS dropoff_at,
       CAST(passenger_count AS INTEGER) AS passenger_count,
       CAST(trip_distance AS DOUBLE) AS trip_distance_miles,
       CAST(pulocationid AS INTEGER) AS pickup_location_id,
       CAST(dolocationid AS INTEGER) AS dropoff_location_id,
       CAST(payment_type AS INTEGER) AS payment_type,
       CAST(fare_amount AS DOUBLE) AS fare_amount,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(trip_duration_minutes AS DOUBLE) AS trip_duration_minutes,
       CAST(is_zero_distance AS BOOLEAN) AS is_zero_distance,
       CAST(has_negative_fare AS BOOLEAN) AS has_negative_fare,
       CAST(has_negative_total AS BOOLEAN) AS has_negative_total,
       CAST(is_passenger_count_null AS BOOLEAN) AS is_passenger_count_null,
       _source_file
FROM silver
"""

ENR = """
SELECT *,
       CAST(pickup_at AS DATE) AS pickup_date,
       CAST(extract(hour FROM pickup_at) AS INTEGER) AS pickup_hour,
       CASE WHEN trip_duration_minutes > 0 AND trip_distance_miles > 0
            THEN trip_distance_miles / (trip_duration_minutes / CAST(60.0 AS DOUBLE))
            ELSE NULL END AS average_speed_mph
FROM stg
"""


def exact_sum(x: str) -> str:
    """SQL for the exact sum of doubles whose last binary digit is 2**-60 or above, as a double."""
    unit = "CAST(1152921504606846976 AS HUGEINT)"
    s = f"SUM(CAST({x} * 1152921504606846976.0 AS HUGEINT))"
    low = f"CAST(CAST(ABS({s}) % {unit} AS BIGINT) AS DOUBLE) / 1152921504606846976.0"
    return f"((CAST(ABS({s}) // {unit} AS DOUBLE) + {low}) * CASE WHEN {s} < 0 THEN -1.0 ELSE 1.0 END)"


def exact_average(x: str) -> str:
    return f"CASE WHEN COUNT({x}) > 0 THEN {exact_sum(x)} / CAST(COUNT({x}) AS DOUBLE) END"


DAILY = f"""
SELECT pickup_date,
       COUNT(*) AS trip_count,
       COUNT(passenger_count) AS trips_with_passenger_count,
       CAST(SUM(passenger_count) AS BIGINT) AS known_passenger_count,
       {exact_sum('trip_distance_miles')} AS total_distance_miles,
       {exact_average('trip_distance_miles')} AS average_trip_distance_miles,
       {exact_average('trip_duration_minutes')} AS average_trip_duration_minutes,
       {exact_sum('fare_amount')} AS total_fare_amount,
       {exact_sum('total_amount')} AS total_amount,
       CASE WHEN COUNT(*) > 0 THEN {exact_sum('total_amount')} / CAST(COUNT(*) AS DOUBLE) END
           AS average_amount_per_trip,
       CAST(SUM(CASE WHEN is_zero_distance THEN 1 ELSE 0 END) AS BIGINT) AS zero_distance_trip_count,
       CAST(SUM(CASE WHEN has_negative_fare THEN 1 ELSE 0 END) AS BIGINT) AS negative_fare_trip_count,
       CAST(SUM(CASE WHEN has_negative_total THEN 1 ELSE 0 END) AS BIGINT) AS negative_total_trip_count,
       CAST(SUM(CASE WHEN is_passenger_count_null THEN 1 ELSE 0 END) AS BIGINT)
           AS missing_passenger_count_trip_count
FROM enr
GROUP BY pickup_date
"""

MONTHLY = f"""
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month,
       CAST(SUM(trip_count) AS BIGINT) AS total_trips,
       {exact_sum('total_amount')} AS total_amount,
       {exact_sum('total_distance_miles')} AS total_distance_miles,
       CASE WHEN SUM(trip_count) > 0
            THEN {exact_sum('total_amount')} / CAST(SUM(trip_count) AS DOUBLE) END
           AS average_amount_per_trip
FROM daily
GROUP BY 1
"""

_QUALITY_PART = """
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month,
       '{label}' AS quality_issue,
       CAST({order} AS INTEGER) AS sort_order,
       CAST(COALESCE(SUM({col}), 0) AS BIGINT) AS issue_count
FROM daily GROUP BY 1
"""

QUALITY = "\nUNION ALL\n".join(
    _QUALITY_PART.format(label=label, order=order, col=col)
    for label, order, col in C.QUALITY_ISSUES
)

# CTE chain: name -> (text, dependencies).
_CTES = {
    "raw": (RAW, ()),
    "bronze": (BRONZE, ("raw",)),
    "ruled": (RULED, ("bronze",)),
    "silver": (SILVER, ("ruled",)),
    "quarantine": (QUARANTINE, ("ruled",)),
    "stg": (STG, ("silver",)),
    "enr": (ENR, ("stg",)),
    "daily": (DAILY, ("enr",)),
    "monthly": (MONTHLY, ("daily",)),
    "quality": (QUALITY, ("daily",)),
}


def with_ctes(body: str, *needs: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][1]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    parts = ",\n".join(f"{name} AS ({_CTES[name][0]})" for name in order)
    return f"WITH {parts}\n{body}"
