"""Data-quality contract: rules evaluated in one aggregate, reported as rows.

A ``Rule`` is a name, a severity and a per-row violation predicate. All rules
of a check are counted in a single ``agg`` (one scan, one partial aggregate
per task, a one-row final aggregate), then the single wide row is turned into
one row per rule. Results are at most tens of rows; data never leaves the
executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import contract as C
from strata.functions import predicates as P
from strata.functions.names import missing_columns
from strata.operators.silver import LAYER_COLUMN, QUARANTINE, SILVER

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("observed", T.LongType(), True),
        T.StructField("passed", T.BooleanType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("expectation", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class Rule:
    """A named check; ``violation`` is true for a row that breaks it."""

    name: str
    severity: str
    violation: Column | None
    expectation: str


def status(passed: Column, severity: Column) -> Column:
    """PASS; otherwise FAIL for a FAIL rule and WARN for a WARN rule."""
    return (
        F.when(passed, F.lit(C.PASS))
        .when(severity == F.lit(C.FAIL), F.lit(C.FAIL))
        .otherwise(F.lit(C.WARN))
    )


def _result_row(name: str, severity: str, observed: Column, expectation: str) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        observed.cast("bigint").alias("observed"),
        (observed == 0).alias("passed"),
        F.lit(expectation).alias("expectation"),
    )


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Count every rule's violations in one pass and return one row per rule.

    A rule whose ``violation`` is ``None`` could not be evaluated (a column it
    needs is absent); it is reported with a NULL count and ``passed`` false.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    counted = [r for r in rules if r.violation is not None]
    aggs = [P.count_true(r.violation).alias(f"c{i}") for i, r in enumerate(counted)]
    wide = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    rows = []
    i = 0
    for r in rules:
        if r.violation is None:
            rows.append(_result_row(r.name, r.severity, F.lit(None).cast("bigint"), r.expectation))
        else:
            rows.append(_result_row(r.name, r.severity, F.col(f"c{i}"), r.expectation))
            i += 1
    out = wide.select(F.inline(F.array(*rows)))
    return out.select(
        "name",
        "severity",
        "observed",
        F.coalesce("passed", F.lit(False)).alias("passed"),
        status(F.coalesce("passed", F.lit(False)), F.col("severity")).alias("status"),
        "expectation",
    )


def metadata_result(spark: SparkSession, name: str, severity: str, observed: int,
                    expectation: str) -> DataFrame:
    """A check computed on the driver from metadata (schema names only)."""
    passed = observed == 0
    st = C.PASS if passed else (C.FAIL if severity == C.FAIL else C.WARN)
    return spark.createDataFrame(
        [(name, severity, int(observed), passed, st, expectation)], RESULT_SCHEMA
    )


# ---------------------------------------------------------------------------
# Raw contract
# ---------------------------------------------------------------------------

def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def raw_null_rules(df: DataFrame, columns: Sequence[str] = C.CRITICAL_RAW_COLUMNS) -> list[Rule]:
    return [
        Rule(f"null_{c}", C.FAIL, F.col(c).isNull() if _has(df, c) else None, "no NULL values")
        for c in columns
    ]


def raw_warning_rules(
    df: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
) -> list[Rule]:
    def ok(*names: str) -> bool:
        return all(_has(df, n) for n in names)

    pickup_type = P.column_type(df, C.PICKUP)
    start, end = P.ts_bound(period_start, pickup_type), P.ts_bound(period_end, pickup_type)
    pickup = F.col(C.PICKUP)
    return [
        Rule(C.PASSENGER_COUNT_NULL, C.WARN,
             F.col(C.PASSENGERS).isNull() if ok(C.PASSENGERS) else None,
             "rows without a passenger count"),
        Rule(C.TRIP_DISTANCE_ZERO, C.WARN,
             (F.col(C.DISTANCE) == 0) if ok(C.DISTANCE) else None,
             "trips of no distance"),
        Rule(C.NEGATIVE_FARE_AMOUNT, C.WARN,
             (F.col(C.FARE) < 0) if ok(C.FARE) else None,
             "amounts below zero"),
        Rule(C.NEGATIVE_TOTAL_AMOUNT, C.WARN,
             (F.col(C.TOTAL) < 0) if ok(C.TOTAL) else None,
             "amounts below zero"),
        Rule(C.DROPOFF_BEFORE_PICKUP, C.WARN,
             (F.col(C.DROPOFF) < pickup) if ok(C.DROPOFF, C.PICKUP) else None,
             "quarantined by the split"),
        Rule(C.PICKUP_OUTSIDE_PERIOD, C.WARN,
             ((pickup < start) | (pickup >= end)) if ok(C.PICKUP) else None,
             "rows of other periods"),
    ]


def required_columns_check(spark: SparkSession, df: DataFrame,
                           required: Sequence[str] = C.REQUIRED_RAW_COLUMNS) -> tuple[DataFrame, list[str]]:
    """Schema check on names only; no data is read."""
    absent = missing_columns(required, df.columns)
    return (
        metadata_result(spark, C.REQUIRED_COLUMNS_RULE, C.FAIL, len(absent),
                        "no required column absent (missing: " + ", ".join(absent) + ")"
                        if absent else "no required column absent"),
        absent,
    )


def check_raw(
    raw: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
) -> DataFrame:
    """Full raw report: schema row, then the null and warning rules.

    When required columns are absent, the report stops after the schema row,
    before any data is scanned.
    """
    spark = raw.sparkSession
    schema_row, absent = required_columns_check(spark, raw)
    if absent:
        return schema_row
    pruned = raw.select(*[c for c in C.RAW_CHECK_COLUMNS if c in raw.columns])
    rules = raw_null_rules(pruned) + raw_warning_rules(pruned, period_start, period_end)
    return schema_row.unionByName(evaluate(pruned, rules))


def verdict(report: DataFrame) -> DataFrame:
    """One row: ``passed`` unless a FAIL rule failed, and how many did."""
    failing = F.count_if(F.col("status") == F.lit(C.FAIL))
    return report.agg(
        (failing == 0).alias("passed"),
        failing.alias("blocking_failures"),
        F.count(F.lit(1)).alias("rules_checked"),
    )


# ---------------------------------------------------------------------------
# Silver contract
# ---------------------------------------------------------------------------

def tagged_union(**sides: DataFrame) -> DataFrame:
    """Stack several inputs, each marked by a non-NULL column named after it.

    A union is narrow (no shuffle); one aggregate over it then counts every
    side at once, which replaces a join of one-row aggregates.
    """
    out = None
    for name, df in sides.items():
        part = df.withColumn(f"_{name}", F.lit(1))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def layer_counts(raw: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row with the three counts, from one aggregate over the three scans.

    Each side is pruned to a constant column, so the scans read no data
    columns (a Parquet count reads only row-group metadata).
    """
    u = tagged_union(raw=raw.select(), silver=silver.select(), quarantine=quarantine.select())
    return u.agg(
        F.count("_raw").alias("raw_count"),
        F.count("_silver").alias("silver_count"),
        F.count("_quarantine").alias("quarantine_count"),
    )


def check_silver(
    raw: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    expected: Sequence[str] = C.EXPECTED_SILVER_COLUMNS,
) -> DataFrame:
    """Reconciliation, schema and the two temporal rules, all FAIL severity.

    The three counts and the temporal rules come from ONE aggregate over a
    narrow union of the inputs: silver is read once (two columns), raw and
    quarantine contribute no data columns.
    """
    spark = silver.sparkSession
    pick, drop = C.PICKUP.lower(), C.DROPOFF.lower()
    absent = missing_columns(expected, silver.columns)
    temporal_ok = pick not in absent and drop not in absent
    if temporal_ok:
        ptype = P.column_type(silver, pick)
        start, end = P.ts_bound(period_start, ptype), P.ts_bound(period_end, ptype)
        p = F.col(pick)
        silver_side = silver.select(
            (F.col(drop) < p).alias("_before"), ((p < start) | (p >= end)).alias("_outside"))
    else:
        silver_side = silver.select()
    u = tagged_union(raw=raw.select(), silver=silver_side, quarantine=quarantine.select())
    aggs = [F.count("_raw").alias("n_raw"), F.count("_silver").alias("n_silver"),
            F.count("_quarantine").alias("n_quarantine")]
    if temporal_ok:
        aggs += [P.count_true(F.col("_before")).alias("n_before"),
                 P.count_true(F.col("_outside")).alias("n_outside")]
    else:
        aggs += [F.lit(None).cast("bigint").alias("n_before"),
                 F.lit(None).cast("bigint").alias("n_outside")]
    diff = F.abs(F.col("n_raw") - F.col("n_silver") - F.col("n_quarantine"))
    rows = F.array(
        _result_row(C.RECONCILIATION, C.FAIL, diff, "raw = silver + quarantine"),
        _result_row(C.DROPOFF_BEFORE_PICKUP, C.FAIL, F.col("n_before"),
                    "no dropoff before pickup"),
        _result_row(C.PICKUP_OUTSIDE_PERIOD, C.FAIL, F.col("n_outside"),
                    "no pickup outside the period"),
    )
    counted = u.agg(*aggs).select(F.inline(rows)).select(
        "name", "severity", "observed",
        F.coalesce("passed", F.lit(False)).alias("passed"),
        status(F.coalesce("passed", F.lit(False)), F.col("severity")).alias("status"),
        "expectation",
    )
    schema_row = metadata_result(spark, C.SILVER_SCHEMA, C.FAIL, len(absent),
                                 "all silver columns present")
    return counted.unionByName(schema_row)


def check_split(labelled: DataFrame, period_start: datetime | date | str,
                period_end: datetime | date | str,
                expected: Sequence[str] = C.EXPECTED_SILVER_COLUMNS) -> DataFrame:
    """The silver contract from ONE scan: the split's rows with their layer."""
    pick, drop = F.col(C.PICKUP.lower()), F.col(C.DROPOFF.lower())
    ptype = P.column_type(labelled, C.PICKUP.lower())
    start, end = P.ts_bound(period_start, ptype), P.ts_bound(period_end, ptype)
    kept = F.col(LAYER_COLUMN) == F.lit(SILVER)
    wide = labelled.agg(
        (F.count(F.lit(1)) - F.count_if(kept)
         - F.count_if(F.col(LAYER_COLUMN) == F.lit(QUARANTINE))).alias("lost"),
        P.count_true(kept & (drop < pick)).alias("n_before"),
        P.count_true(kept & ((pick < start) | (pick >= end))).alias("n_outside"))
    absent = len(missing_columns(expected, labelled.columns))
    rows = F.array(
        _result_row(C.RECONCILIATION, C.FAIL, F.abs("lost"), "raw = silver + quarantine"),
        _result_row(C.SILVER_SCHEMA, C.FAIL, F.lit(absent), "all silver columns present"),
        _result_row(C.DROPOFF_BEFORE_PICKUP, C.FAIL, F.col("n_before"), "no dropoff before pickup"),
        _result_row(C.PICKUP_OUTSIDE_PERIOD, C.FAIL, F.col("n_outside"), "no pickup outside the period"))
    return wide.select(F.inline(rows)).select(
        "name", "severity", "observed", "passed", status(F.col("passed"), F.col("severity")).alias("status"),
        "expectation")


def silver_verdict(report: DataFrame) -> DataFrame:
    """Passes only when every silver check passes."""
    return report.agg(
        F.bool_and("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.count(F.lit(1)).alias("checks"),
    )


# ---------------------------------------------------------------------------
# Mart contract (tests that return failing rows)
# ---------------------------------------------------------------------------

def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failing rows of a not-null test: any listed column is NULL."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def not_null_summary(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: model, column, NULL count, passed (one aggregate)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                 F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ])
    return wide.select(F.inline(rows)).withColumn("passed", F.col("null_count") == 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once; rows with a NULL key are ignored."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return (
        df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def unique_summary(model: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    dups = duplicate_keys(df, keys)
    return dups.agg(
        F.lit(model).alias("model"),
        F.lit(",".join(keys)).alias("grain"),
        F.count(F.lit(1)).alias("duplicate_keys"),
    ).withColumn("passed", F.col("duplicate_keys") == 0)


def mart_reconciles(staged: DataFrame, daily: DataFrame) -> DataFrame:
    """Staging rows vs the daily mart's trips; null-safe so an empty mart fails."""
    u = tagged_union(staged=staged.select(), mart=daily.select("trip_count"))
    return u.agg(
        F.count("_staged").alias("staging_row_count"),
        F.sum(F.when(F.col("_mart").isNotNull(), F.col("trip_count"))).alias("mart_row_count"),
    ).withColumn("passed", F.col("staging_row_count").eqNullSafe(F.col("mart_row_count")))


def mart_reconcile_failures(staged: DataFrame, daily: DataFrame) -> DataFrame:
    """The test form: returns a row only when the counts differ."""
    return mart_reconciles(staged, daily).filter(~F.col("passed")).drop("passed")


# ---------------------------------------------------------------------------
# Rule catalogue: the three-way classification
# ---------------------------------------------------------------------------

RULE_CATALOG = (
    # (rule, where it applies, classification)
    ("null_<critical column>", "raw", "blocking"),
    (C.REQUIRED_COLUMNS_RULE, "raw", "blocking"),
    (C.PASSENGER_COUNT_NULL, "raw", "warning"),
    (C.TRIP_DISTANCE_ZERO, "raw", "warning"),
    (C.NEGATIVE_FARE_AMOUNT, "raw", "warning"),
    (C.NEGATIVE_TOTAL_AMOUNT, "raw", "warning"),
    (C.DROPOFF_BEFORE_PICKUP, "raw", "warning"),
    (C.PICKUP_OUTSIDE_PERIOD, "raw", "warning"),
    (C.MISSING_PICKUP, "silver split", "quarantine"),
    (C.MISSING_DROPOFF, "silver split", "quarantine"),
    (C.PICKUP_OUTSIDE_PERIOD, "silver split", "quarantine"),
    (C.DROPOFF_BEFORE_PICKUP, "silver split", "quarantine"),
    (C.IS_ZERO_DISTANCE, "silver flag", "warning"),
    (C.HAS_NEGATIVE_FARE, "silver flag", "warning"),
    (C.HAS_NEGATIVE_TOTAL, "silver flag", "warning"),
    (C.IS_PASSENGER_COUNT_NULL, "silver flag", "warning"),
    (C.RECONCILIATION, "silver", "blocking"),
    (C.SILVER_SCHEMA, "silver", "blocking"),
    (C.DROPOFF_BEFORE_PICKUP, "silver", "blocking"),
    (C.PICKUP_OUTSIDE_PERIOD, "silver", "blocking"),
)
