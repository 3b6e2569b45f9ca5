"""Fixed names of the trip data contract.

Everything in this module is a value that has to be spelled exactly this way
for results to line up with the published layers and reports; it is data, not
logic. Every operator takes these as defaults and accepts other names.
"""

from __future__ import annotations

# --- fixed values: raw trip column names -----------------------------------
VENDOR = "VendorID"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PASSENGERS = "passenger_count"
DISTANCE = "trip_distance"
PU_LOCATION = "PULocationID"
DO_LOCATION = "DOLocationID"
PAYMENT = "payment_type"
FARE = "fare_amount"
TIP = "tip_amount"
TOTAL = "total_amount"

# --- fixed values: raw contract ---------------------------------------------
# Names that must be present in the raw file (a subset check; extra columns pass).
REQUIRED_RAW_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
)
# Columns read by the raw checks (passenger_count is read but not required).
RAW_CHECK_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
)
# Columns that must not hold NULLs (blocking); fare_amount is required but not null-checked.
CRITICAL_RAW_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "total_amount",
)
# Columns the profile reads.
PROFILE_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)

# --- fixed values: silver contract ------------------------------------------
SOURCE_FILE_COLUMN = "_source_file"
REASON_COLUMN = "_quarantine_reason"
DURATION_COLUMN = "trip_duration_minutes"
EXPECTED_SILVER_COLUMNS = (
    "vendorid",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "fare_amount",
    "total_amount",
    "trip_duration_minutes",
    "is_zero_distance",
    "has_negative_fare",
    "has_negative_total",
    "is_passenger_count_null",
    "_source_file",
)

# --- fixed values: blocking split rules, in reason order --------------------
MISSING_PICKUP = "missing_pickup_datetime"
MISSING_DROPOFF = "missing_dropoff_datetime"
PICKUP_OUTSIDE_PERIOD = "pickup_outside_period"
DROPOFF_BEFORE_PICKUP = "dropoff_before_pickup"
REASON_SEPARATOR = ";"

# --- fixed values: non-blocking quality flags -------------------------------
IS_ZERO_DISTANCE = "is_zero_distance"
HAS_NEGATIVE_FARE = "has_negative_fare"
HAS_NEGATIVE_TOTAL = "has_negative_total"
IS_PASSENGER_COUNT_NULL = "is_passenger_count_null"

# --- fixed values: check severities and statuses ----------------------------
FAIL = "FAIL"
WARN = "WARN"
PASS = "PASS"

# --- fixed values: raw warning rule names -----------------------------------
PASSENGER_COUNT_NULL = "passenger_count_null"
TRIP_DISTANCE_ZERO = "trip_distance_zero"
NEGATIVE_FARE_AMOUNT = "negative_fare_amount"
NEGATIVE_TOTAL_AMOUNT = "negative_total_amount"
REQUIRED_COLUMNS_RULE = "required_columns"

# --- fixed values: silver check names ----------------------------------------
RECONCILIATION = "reconciliation"
SILVER_SCHEMA = "silver_schema"

# --- fixed values: quality summary labels and sort order --------------------
QUALITY_ISSUES = (
    ("Missing passenger count", 1, "missing_passenger_count_trip_count"),
    ("Zero distance", 2, "zero_distance_trip_count"),
    ("Negative total amount", 3, "negative_total_trip_count"),
    ("Negative fare", 4, "negative_fare_trip_count"),
)

# --- fixed values: zone dimension -------------------------------------------
ZONE_COUNT = 265
ZONE_LABEL_PREFIX = "zone_"
