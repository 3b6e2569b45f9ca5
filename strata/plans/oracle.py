"""DuckDB oracle texts keyed like ``registry.QUERIES``.

Each text restates the query in plain SQL over the registered driver tables
(through the CTE chain of ``oracle_base``), with the same column names.
"""

from __future__ import annotations

from strata.functions import contract as C
from strata.plans.fixtures import PERIOD_END, PERIOD_START
from strata.plans.oracle_base import exact_average, exact_sum, with_ctes

_PS, _PE = f"TIMESTAMP '{PERIOD_START}'", f"TIMESTAMP '{PERIOD_END}'"
_PICK, _DROP = "tpep_pickup_datetime", "tpep_dropoff_datetime"
_OUTSIDE = f"COALESCE({_PICK} IS NOT NULL AND ({_PICK} < {_PS} OR {_PICK} >= {_PE}), false)"
_BEFORE = (f"COALESCE({_PICK} IS NOT NULL AND {_DROP} IS NOT NULL AND {_DROP} < {_PICK}, false)")
_DUR = f"datesub('second', {_PICK}, {_DROP}) / CAST(60.0 AS DOUBLE)"
_FLAGS = """trip_distance = 0 AS is_zero_distance, fare_amount < 0 AS has_negative_fare,
  total_amount < 0 AS has_negative_total, passenger_count IS NULL AS is_passenger_count_null"""
_STATUS = "CASE WHEN observed = 0 THEN 'PASS' WHEN severity = 'FAIL' THEN 'FAIL' ELSE 'WARN' END"


def _report(agg_cte: str, rules: list[tuple[str, str, str]]) -> str:
    """Rows (name, severity, observed, passed, status, expectation) from one aggregate.

    ``rules``: (name, severity, expectation); observed is column ``c<i>`` of ``agg_cte``.
    """
    parts = [
        f"SELECT '{n}' AS name, '{s}' AS severity, CAST(c{i} AS BIGINT) AS observed, "
        f"'{e}' AS expectation FROM {agg_cte}"
        for i, (n, s, e) in enumerate(rules)
    ]
    return ("SELECT name, severity, observed, observed = 0 AS passed, "
            f"{_STATUS} AS status, expectation FROM ({' UNION ALL '.join(parts)})")


def _null_rules_meta():
    return [(f"null_{c}", C.FAIL, "no NULL values") for c in C.CRITICAL_RAW_COLUMNS]


_WARN_META = [
    (C.PASSENGER_COUNT_NULL, C.WARN, "rows without a passenger count", "passenger_count IS NULL"),
    (C.TRIP_DISTANCE_ZERO, C.WARN, "trips of no distance", "trip_distance = 0"),
    (C.NEGATIVE_FARE_AMOUNT, C.WARN, "amounts below zero", "fare_amount < 0"),
    (C.NEGATIVE_TOTAL_AMOUNT, C.WARN, "amounts below zero", "total_amount < 0"),
    (C.DROPOFF_BEFORE_PICKUP, C.WARN, "quarantined by the split", f"{_DROP} < {_PICK}"),
    (C.PICKUP_OUTSIDE_PERIOD, C.WARN, "rows of other periods",
     f"({_PICK} < {_PS} OR {_PICK} >= {_PE})"),
]


def _raw_report_parts():
    nulls = [f'COUNT_IF("{c}" IS NULL)' for c in C.CRITICAL_RAW_COLUMNS]
    warns = [f"COUNT_IF({cond})" for *_, cond in _WARN_META]
    return nulls, warns


def _ctes(body: str, *needs: str, extra: str = "") -> str:
    sql = with_ctes(body, *needs)
    if extra:
        head, _, tail = sql.partition("\n" + body)
        return f"{head},\n{extra}\n{body}"
    return sql


def _raw_check_sql(which: str, wrap: str = "{}") -> str:
    nulls, warns = _raw_report_parts()
    if which == "nulls":
        exprs, meta = nulls, _null_rules_meta()
    elif which == "warn":
        exprs, meta = warns, [m[:3] for m in _WARN_META]
    else:
        exprs, meta = nulls + warns, _null_rules_meta() + [m[:3] for m in _WARN_META]
    aggs = ", ".join(f"{e} AS c{i}" for i, e in enumerate(exprs))
    body = _report("a", meta)
    if which == "report":
        body = (f"SELECT '{C.REQUIRED_COLUMNS_RULE}' AS name, 'FAIL' AS severity, "
                "CAST(0 AS BIGINT) AS observed, true AS passed, 'PASS' AS status, "
                "'no required column absent' AS expectation UNION ALL " + body)
    body = wrap.format(f"({body})") if wrap != "{}" else body
    return _ctes(body, "raw", extra=f"a AS (SELECT {aggs} FROM raw)")


_CHECK_SILVER_BODY = f"""
SELECT '{C.RECONCILIATION}' AS name, 'FAIL' AS severity,
       CAST(abs(r.n - s.n - q.n) AS BIGINT) AS observed,
       abs(r.n - s.n - q.n) = 0 AS passed,
       CASE WHEN abs(r.n - s.n - q.n) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       'raw = silver + quarantine' AS expectation
FROM (SELECT COUNT(*) AS n FROM raw) r, (SELECT COUNT(*) AS n FROM silver) s,
     (SELECT COUNT(*) AS n FROM quarantine) q
UNION ALL
SELECT '{C.SILVER_SCHEMA}', 'FAIL', CAST(0 AS BIGINT), true, 'PASS', 'all silver columns present'
UNION ALL
SELECT * FROM ({_report('t', [(C.DROPOFF_BEFORE_PICKUP, C.FAIL, 'no dropoff before pickup'),
                              (C.PICKUP_OUTSIDE_PERIOD, C.FAIL, 'no pickup outside the period')])})
"""
_CHECK_SILVER_T = (f"t AS (SELECT COUNT_IF({_DROP} < {_PICK}) AS c0, "
                   f"COUNT_IF({_PICK} < {_PS} OR {_PICK} >= {_PE}) AS c1 FROM silver)")


def _check_silver_sql(body_wrap: str = "{}") -> str:
    body = body_wrap.format(f"({_CHECK_SILVER_BODY})")
    return _ctes(body, "raw", "silver", "quarantine", extra=_CHECK_SILVER_T)


def _not_null_part(model: str, table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, COUNT_IF({c} IS NULL) AS null_count, "
        f"COUNT_IF({c} IS NULL) = 0 AS passed FROM {table}"
        for c in cols
    )


def _unique_part(model: str, table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    notnull = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    return (f"SELECT '{model}' AS model, '{','.join(keys)}' AS grain, COUNT(*) AS duplicate_keys, "
            f"COUNT(*) = 0 AS passed FROM (SELECT {k} FROM {table} WHERE {notnull} "
            f"GROUP BY {k} HAVING COUNT(*) > 1)")


# The 27 rules: rule, stage, classification and what counts as a finding.
_KEPT = (f"{_PICK} IS NOT NULL AND {_DROP} IS NOT NULL AND {_PICK} >= {_PS} AND {_PICK} < {_PE} "
         f"AND {_DROP} >= {_PICK}")
_RULES = [
    ("null_VendorID", "raw", "blocking", 'COUNT_IF("VendorID" IS NULL)'),
    ("null_tpep_pickup_datetime", "raw", "blocking", f"COUNT_IF({_PICK} IS NULL)"),
    ("null_tpep_dropoff_datetime", "raw", "blocking", f"COUNT_IF({_DROP} IS NULL)"),
    ("null_trip_distance", "raw", "blocking", "COUNT_IF(trip_distance IS NULL)"),
    ("null_PULocationID", "raw", "blocking", 'COUNT_IF("PULocationID" IS NULL)'),
    ("null_DOLocationID", "raw", "blocking", 'COUNT_IF("DOLocationID" IS NULL)'),
    ("null_payment_type", "raw", "blocking", "COUNT_IF(payment_type IS NULL)"),
    ("null_total_amount", "raw", "blocking", "COUNT_IF(total_amount IS NULL)"),
    ("required_columns", "raw", "blocking", "0"),
    ("passenger_count_null", "raw", "warning", "COUNT_IF(passenger_count IS NULL)"),
    ("trip_distance_zero", "raw", "warning", "COUNT_IF(trip_distance = 0)"),
    ("negative_fare_amount", "raw", "warning", "COUNT_IF(fare_amount < 0)"),
    ("negative_total_amount", "raw", "warning", "COUNT_IF(total_amount < 0)"),
    ("dropoff_before_pickup", "raw", "warning", f"COUNT_IF({_DROP} < {_PICK})"),
    ("pickup_outside_period", "raw", "warning", f"COUNT_IF({_PICK} < {_PS} OR {_PICK} >= {_PE})"),
    ("missing_pickup_datetime", "silver split", "quarantine", f"COUNT_IF({_PICK} IS NULL)"),
    ("missing_dropoff_datetime", "silver split", "quarantine", f"COUNT_IF({_DROP} IS NULL)"),
    ("pickup_outside_period", "silver split", "quarantine", f"COUNT_IF({_PICK} < {_PS} OR {_PICK} >= {_PE})"),
    ("dropoff_before_pickup", "silver split", "quarantine", f"COUNT_IF({_DROP} < {_PICK})"),
    ("is_zero_distance", "silver flag", "warning", "COUNT_IF(trip_distance = 0)"),
    ("has_negative_fare", "silver flag", "warning", "COUNT_IF(fare_amount < 0)"),
    ("has_negative_total", "silver flag", "warning", "COUNT_IF(total_amount < 0)"),
    ("is_passenger_count_null", "silver flag", "warning", "COUNT_IF(passenger_count IS NULL)"),
    ("reconciliation", "silver", "blocking", "0"),
    ("silver_schema", "silver", "blocking", "0"),
    ("dropoff_before_pickup", "silver", "blocking", f"COUNT_IF(({_KEPT}) AND {_DROP} < {_PICK})"),
    ("pickup_outside_period", "silver", "blocking", f"COUNT_IF(({_KEPT}) AND ({_PICK} < {_PS} OR {_PICK} >= {_PE}))"),
]


def _rule_catalog_sql() -> str:
    aggs = ", ".join(f"CAST({c} AS BIGINT) AS v{i}" for i, (*_, c) in enumerate(_RULES))
    body = " UNION ALL ".join(
        f"SELECT '{n}' AS rule, '{s}' AS stage, '{k}' AS classification, v{i} AS rows_flagged FROM a"
        for i, (n, s, k, _) in enumerate(_RULES)
    )
    return _ctes(body, "bronze", extra=f"a AS (SELECT {aggs} FROM bronze)")


_FILES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
_NAMES = "(VALUES " + ", ".join(f"('{n}')" for n in _FILES) + ") f(name)"
_COUNTS = """(SELECT COUNT(*) FROM raw) AS raw_rows, (SELECT COUNT(*) FROM silver) AS silver_rows,
  (SELECT COUNT(*) FROM quarantine) AS quarantine_rows"""


def _steps_sql(rows: list[tuple]) -> str:
    """Audit rows; a count is written as the name of a column of ``n``, a table as text or null."""
    quoted = lambda v: "NULL" if v is None else f"'{v}'"
    number = lambda v: f"CAST({v or 'NULL'} AS BIGINT)"
    body = " UNION ALL ".join(
        f"SELECT 'trips_medallion' AS pipeline, '{step}' AS step, 'SUCCESS' AS status, "
        f"CAST({quoted(name)} AS VARCHAR) AS table_name, {number(r)} AS raw_count, {number(s)} AS silver_count, "
        f"{number(q)} AS quarantine_count, CAST(NULL AS VARCHAR) AS error_type FROM n"
        for step, name, r, s, q in rows)
    return _ctes(body, "raw", "silver", "quarantine", extra=f"n AS (SELECT {_COUNTS})")


_BRONZE_STEP = ("bronze", "strata_bronze.trips", "raw_rows", None, None)
_SILVER_STEP = ("silver", "strata_silver.trips", "raw_rows", "silver_rows", "quarantine_rows")


_QUAR_SAMPLE = f"""
SELECT {_PICK}, {_DROP}, _quarantine_reason FROM quarantine
ORDER BY {_PICK} ASC NULLS FIRST, {_DROP} ASC NULLS FIRST, _quarantine_reason ASC NULLS FIRST
LIMIT 20
"""

_DAILY_STUDY = f"""
SELECT CAST({_PICK} AS DATE) AS pickup_date, COUNT(*) AS trip_count,
       {exact_sum('trip_distance')} AS total_distance,
       {exact_average(_DUR)} AS avg_duration_minutes
FROM raw WHERE {_PICK} >= {_PS} AND {_PICK} < {_PE}
GROUP BY 1
"""

_ZONE = f"""
SELECT t.pickup_location_id, t.total_amount, z.location_id, z.zone_label
FROM (SELECT "PULocationID" AS pickup_location_id, total_amount FROM raw
      WHERE {_PICK} >= {_PS} AND {_PICK} < {_PE}) t
LEFT JOIN (SELECT CAST(i AS INTEGER) AS location_id, 'zone_' || CAST(i AS VARCHAR) AS zone_label
           FROM range(1, {C.ZONE_COUNT + 1}) r(i)) z
ON t.pickup_location_id = z.location_id
"""

_PROFILE_PRESENT = [c for c in C.PROFILE_COLUMNS if c != C.TIP]
_PROFILE_NULLS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, COUNT_IF(\"{c}\" IS NULL) AS null_count, "
    f"CASE WHEN COUNT(*) > 0 THEN CAST(COUNT_IF(\"{c}\" IS NULL) AS DOUBLE) / "
    f"CAST(COUNT(*) AS DOUBLE) * 100.0 ELSE 0.0 END AS null_percent FROM raw"
    for i, c in enumerate(_PROFILE_PRESENT)
)

_PROFILE_RULES = " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT_IF({p}) AS row_count FROM raw"
    for n, p in (
        ("trip_distance_negative", "trip_distance < 0"),
        ("trip_distance_zero", "trip_distance = 0"),
        ("fare_amount_negative", "fare_amount < 0"),
        ("total_amount_negative", "total_amount < 0"),
        ("dropoff_before_pickup", f"{_DROP} < {_PICK}"),
    )
)

_SILVER_METRICS = f"""
SELECT COUNT(*) AS silver_count,
       COUNT_IF({_PICK} < {_PS} OR {_PICK} >= {_PE}) AS pickup_outside_period,
       COUNT_IF({_DROP} < {_PICK}) AS dropoff_before_pickup,
       COUNT_IF(is_zero_distance) AS zero_distance_rows,
       COUNT_IF(has_negative_fare) AS negative_fare_rows,
       COUNT_IF(has_negative_total) AS negative_total_rows,
       COUNT_IF(is_passenger_count_null) AS passenger_count_null_rows
FROM silver
"""

_CHECKPOINT = f"""
SELECT b.bronze_count, s.silver_count, q.quarantine_count,
       b.bronze_count = s.silver_count + q.quarantine_count AS reconciled,
       s.pickup_outside_period, s.dropoff_before_pickup, s.zero_distance_rows,
       s.negative_fare_rows, s.negative_total_rows, s.passenger_count_null_rows
FROM (SELECT COUNT(*) AS bronze_count FROM bronze) b
CROSS JOIN ({_SILVER_METRICS}) s
CROSS JOIN (SELECT COUNT(*) AS quarantine_count FROM quarantine) q
"""

_SILVER_YM = (f"SELECT *, CAST(year({_PICK}) AS INTEGER) AS year, "
              f"CAST(month({_PICK}) AS INTEGER) AS month FROM silver")

_MONTHLY = ("SELECT pickup_month, total_trips, total_amount, total_distance_miles, average_amount_per_trip "
            "FROM monthly")

ORACLE: dict[str, str] = {
    "scan_raw": with_ctes("SELECT * FROM raw", "raw"),
    "scan_pruned": with_ctes(
        f"SELECT {_PICK}, {_DROP}, trip_distance, fare_amount, total_amount FROM raw", "raw"),
    "bronze_lineage": with_ctes("SELECT * FROM bronze", "bronze"),
    "normalize_columns": with_ctes(
        'SELECT "VendorID" AS vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, '
        'passenger_count, trip_distance, "PULocationID" AS pulocationid, '
        '"DOLocationID" AS dolocationid, payment_type, fare_amount, total_amount, _source_file '
        "FROM bronze", "bronze"),
    "rule_missing_ts": with_ctes(
        f"SELECT {_PICK}, {_DROP}, {_PICK} IS NULL AS missing_pickup_datetime, "
        f"{_DROP} IS NULL AS missing_dropoff_datetime FROM bronze", "bronze"),
    "rule_outside_period": with_ctes(
        f"SELECT {_PICK}, {_OUTSIDE} AS pickup_outside_period FROM bronze", "bronze"),
    "rule_negative_interval": with_ctes(
        f"SELECT {_PICK}, {_DROP}, {_BEFORE} AS dropoff_before_pickup FROM bronze", "bronze"),
    "trip_duration": with_ctes(
        f"SELECT {_PICK}, {_DROP}, {_DUR} AS trip_duration_minutes FROM raw", "raw"),
    # a decimal quotient has six places
    "trip_duration_decimal": with_ctes(
        f"SELECT {_PICK}, {_DROP}, round({_DUR}, 6) AS trip_duration_minutes FROM raw", "raw"),
    "quality_flags": with_ctes(
        f"SELECT trip_distance, fare_amount, total_amount, passenger_count, {_FLAGS} FROM raw",
        "raw"),
    "silver_trips": with_ctes("SELECT * FROM silver", "silver"),
    "quarantine_trips": with_ctes("SELECT * FROM quarantine", "quarantine"),
    "quarantine_reason": with_ctes(
        f"SELECT {_PICK}, {_DROP}, _quarantine_reason FROM quarantine", "quarantine"),
    "stg_trips": with_ctes("SELECT * FROM stg", "stg"),
    "int_trips_enriched": with_ctes("SELECT * FROM enr", "enr"),
    "period_filter_strings": with_ctes(
        f"SELECT * FROM raw WHERE {_PICK} >= {_PS} AND {_PICK} < {_PE}", "raw"),
    "zone_join_merge": with_ctes(_ZONE, "raw"),
    "zone_join_broadcast": with_ctes(_ZONE, "raw"),
    "checkpoint_report": with_ctes(_CHECKPOINT, "bronze", "silver", "quarantine"),
    "check_mart_reconciles": with_ctes(
        "SELECT s.staging_row_count, m.mart_row_count, "
        "s.staging_row_count IS NOT DISTINCT FROM m.mart_row_count AS passed "
        "FROM (SELECT COUNT(*) AS staging_row_count FROM stg) s "
        "CROSS JOIN (SELECT CAST(SUM(trip_count) AS BIGINT) AS mart_row_count FROM daily) m",
        "stg", "daily"),
    "profile_overview": with_ctes(
        f"SELECT COUNT(*) AS row_count, MIN({_PICK}) AS min_pickup, MAX({_PICK}) AS max_pickup, "
        f"MIN({_DROP}) AS min_dropoff, MAX({_DROP}) AS max_dropoff, "
        "COUNT(DISTINCT _source_file) AS source_files FROM bronze", "bronze"),
    "rule_counts": with_ctes(
        f"SELECT COUNT_IF({_PICK} IS NULL) AS missing_pickup_datetime, "
        f"COUNT_IF({_DROP} IS NULL) AS missing_dropoff_datetime, "
        f"COUNT_IF({_OUTSIDE}) AS pickup_outside_period, "
        f"COUNT_IF({_BEFORE}) AS dropoff_before_pickup, "
        "COUNT_IF(trip_distance = 0) AS zero_distance, COUNT_IF(fare_amount < 0) AS negative_fare, "
        "COUNT_IF(total_amount < 0) AS negative_total, "
        "COUNT_IF(passenger_count IS NULL) AS passenger_count_null FROM bronze", "bronze"),
    "profile_nulls": with_ctes(_PROFILE_NULLS, "raw"),
    "profile_rules": with_ctes(_PROFILE_RULES, "raw"),
    "mart_daily": with_ctes("SELECT * FROM daily", "daily"),
    "daily_study": with_ctes(_DAILY_STUDY, "raw"),
    "mart_monthly": with_ctes(_MONTHLY, "monthly"),
    "mart_quality": with_ctes("SELECT * FROM quality", "quality"),
    "quarantine_reasons": with_ctes(
        "SELECT _quarantine_reason, COUNT(*) AS row_count FROM quarantine "
        "GROUP BY _quarantine_reason ORDER BY _quarantine_reason", "quarantine"),
    "check_unique_grain": with_ctes(
        " UNION ALL ".join([
            _unique_part("mart_daily_trip_metrics", "daily", ["pickup_date"]),
            _unique_part("mart_monthly_trip_kpis", "monthly", ["pickup_month"]),
            _unique_part("mart_data_quality_summary", "quality", ["pickup_month", "quality_issue"]),
        ]), "daily", "monthly", "quality"),
    "validate_gold": with_ctes(
        "SELECT COUNT(*) AS day_count, CAST(SUM(trip_count) AS BIGINT) AS total_trip_count, "
        "MIN(pickup_date) AS min_pickup_date, MAX(pickup_date) AS max_pickup_date, "
        "CAST(SUM(zero_distance_trip_count) AS BIGINT) AS zero_distance_trip_count, "
        "CAST(SUM(negative_fare_trip_count) AS BIGINT) AS negative_fare_trip_count, "
        "CAST(SUM(negative_total_trip_count) AS BIGINT) AS negative_total_trip_count, "
        "CAST(SUM(missing_passenger_count_trip_count) AS BIGINT) "
        "AS missing_passenger_count_trip_count FROM daily", "daily"),
    "layer_counts": with_ctes(
        "SELECT (SELECT COUNT(*) FROM bronze) AS bronze_count, "
        "(SELECT COUNT(*) FROM silver) AS silver_count, "
        "(SELECT COUNT(*) FROM quarantine) AS quarantine_count", "bronze", "silver", "quarantine"),
    "silver_metrics": with_ctes(_SILVER_METRICS, "silver"),
    "daily_study_top31": with_ctes(
        f"SELECT * FROM ({_DAILY_STUDY}) ORDER BY pickup_date LIMIT 31", "raw"),
    "quarantine_sample": with_ctes(_QUAR_SAMPLE, "quarantine"),
    "dash_quality": with_ctes(
        "SELECT pickup_month, quality_issue, sort_order, issue_count FROM quality "
        "ORDER BY pickup_month, issue_count DESC, sort_order", "quality"),
    "dash_monthly": with_ctes(
        f"{_MONTHLY} ORDER BY pickup_month", "monthly"),
    "dash_daily": with_ctes(
        "SELECT pickup_date, trip_count, average_amount_per_trip "
        "FROM daily ORDER BY pickup_date",
        "daily"),
    "mart_quality_union": with_ctes("SELECT * FROM quality", "quality"),
    "distinct_source_files": with_ctes("SELECT DISTINCT _source_file FROM bronze", "bronze"),
    "check_raw_nulls": _raw_check_sql("nulls"),
    "check_raw_warn": _raw_check_sql("warn"),
    "check_raw_report": _raw_check_sql("report"),
    "check_raw_verdict": _raw_check_sql(
        "report",
        "SELECT COUNT_IF(status = 'FAIL') = 0 AS passed, "
        "COUNT_IF(status = 'FAIL') AS blocking_failures, COUNT(*) AS rules_checked FROM {}"),
    "check_silver": _check_silver_sql(),
    "check_silver_verdict": _check_silver_sql(
        "SELECT bool_and(passed) AS passed, COUNT_IF(NOT passed) AS failed_checks, "
        "COUNT(*) AS checks FROM {}"),
    "check_not_null": with_ctes(
        " UNION ALL ".join([
            _not_null_part("stg_trips", "stg", ["pickup_at", "dropoff_at", "_source_file"]),
            _not_null_part("mart_daily_trip_metrics", "daily", ["pickup_date", "trip_count"]),
            _not_null_part("mart_monthly_trip_kpis", "monthly", ["pickup_month", "total_trips"]),
            _not_null_part("mart_data_quality_summary", "quality",
                           ["pickup_month", "quality_issue", "issue_count"]),
        ]), "stg", "daily", "monthly", "quality"),
    "rule_catalog": _rule_catalog_sql(),
    "widget_total_trips": with_ctes(
        "SELECT CAST(SUM(total_trips) AS BIGINT) AS total_trips FROM monthly", "monthly"),
    "widget_total_amount": with_ctes(
        f"SELECT {exact_sum('total_amount')} AS total_amount FROM monthly", "monthly"),
    "widget_total_distance": with_ctes(
        f"SELECT {exact_sum('total_distance_miles')} AS total_distance_miles FROM monthly", "monthly"),
    "widget_avg_amount": with_ctes(
        "SELECT MAX(average_amount_per_trip) AS average_amount_per_trip FROM monthly "
        "WHERE pickup_month = DATE '1996-01-01'", "monthly"),
    "widget_daily_trips": with_ctes(
        "SELECT pickup_date, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM daily "
        "GROUP BY pickup_date", "daily"),
    "widget_daily_avg": with_ctes(
        "SELECT CAST(date_trunc('day', pickup_date) AS DATE) AS pickup_day, "
        f"{exact_average('average_amount_per_trip')} AS average_amount_per_trip FROM daily GROUP BY 1", "daily"),
    "widget_quality": with_ctes(
        "SELECT quality_issue, issue_count FROM quality ORDER BY issue_count DESC", "quality"),
    "mart_row_counts": with_ctes(
        "SELECT 'mart_daily_trip_metrics' AS mart, COUNT(*) AS row_count FROM daily UNION ALL "
        "SELECT 'mart_monthly_trip_kpis', COUNT(*) FROM monthly UNION ALL "
        "SELECT 'mart_data_quality_summary', COUNT(*) FROM quality", "daily", "monthly", "quality"),
    "scan_table": with_ctes("SELECT * FROM bronze", "bronze"),
    "publish_roundtrip": with_ctes("SELECT * FROM bronze", "bronze"),
    "publish_atomic": with_ctes("SELECT * FROM bronze", "bronze"),
    "full_refresh_idempotent": with_ctes("SELECT * FROM bronze", "bronze"),
    "job_bronze": with_ctes("SELECT * FROM bronze", "bronze"),
    "publish_partitioned": with_ctes(_SILVER_YM, "silver"),
    "scan_partitioned": with_ctes(_SILVER_YM, "silver"),
    "job_silver": with_ctes(_SILVER_YM, "silver"),
    "job_gold": with_ctes("SELECT * FROM daily", "daily"),
    "scan_partitioned_month": with_ctes(
        f"SELECT * FROM ({_SILVER_YM}) WHERE year = 1996 AND month = 2", "silver"),
    "stale_quarantine": with_ctes(
        "SELECT COUNT(*) AS first_run_quarantine, CAST(0 AS BIGINT) AS second_run_quarantine, "
        "CAST(0 AS BIGINT) AS quarantine_rows_visible FROM quarantine", "quarantine"),
    "optional_count": with_ctes(
        "SELECT 'silver' AS dataset, true AS required, COUNT(*) AS row_count FROM silver UNION ALL "
        "SELECT 'not_written', false, 0", "silver"),
    "reconcile_before_publish": _ctes(
        "SELECT 'silver' AS layer, silver_rows AS rows_read_back, silver_rows AS rows_observed, "
        "raw_rows AS raw_observed, raw_rows = silver_rows + quarantine_rows AS reconciled FROM n UNION ALL "
        "SELECT 'quarantine', quarantine_rows, quarantine_rows, raw_rows, "
        "raw_rows = silver_rows + quarantine_rows FROM n", "raw", "silver", "quarantine",
        extra=f"n AS (SELECT {_COUNTS})"),
    "audit_append": _steps_sql([_BRONZE_STEP, _SILVER_STEP]),
    "run_pipeline": _steps_sql([
        ("landing", None, None, None, None), ("raw_validation", None, "raw_rows", None, None),
        _BRONZE_STEP, _SILVER_STEP,
        ("gold_daily", "strata_gold.mart_daily_trip_metrics", None, None, None),
        ("gold_monthly", "strata_gold.mart_monthly_trip_kpis", None, None, None),
        ("gold_quality", "strata_gold.mart_data_quality_summary", None, None, None)]),
    "table_history": with_ctes(
        "SELECT 'strata_bronze.trips' AS table_name, CAST(v AS BIGINT) AS version, 'bronze' AS operation, "
        "(SELECT COUNT(*) FROM raw) AS raw_count FROM range(2) t(v)", "raw"),
    "landing_integrity": f"SELECT name, true AS has_magic, true AS valid FROM {_NAMES}",
    "landing_length": (f"SELECT name, true AS valid, length(name) % 2 = 0 AS length_ok, "
                       f"length(name) % 2 = 0 AS accepted FROM {_NAMES}"),
    "landing_new_files": f"SELECT name, true AS valid FROM {_NAMES} WHERE name >= 'n'",
    "silver_trips_stream": with_ctes("SELECT * FROM silver", "silver"),
}
