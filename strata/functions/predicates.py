"""Column expressions for the trip rules: period bounds, blocking rules, flags.

All of these are plain Catalyst expressions (no Python on executors), so they
stay inside whole-stage codegen and comparisons of a bare column against a
literal are pushed into the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import contract as C


def _as_datetime(value: datetime | date | str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, str):
        return datetime.fromisoformat(value.strip())
    return datetime(value.year, value.month, value.day)


def check_period(period_start: datetime | date | str, period_end: datetime | date | str) -> None:
    """Reject an empty or inverted half-open period before any plan is built."""
    if _as_datetime(period_start) >= _as_datetime(period_end):
        raise ValueError("period_start must be earlier than period_end")


def _as_text(value: datetime | date | str) -> str:
    if isinstance(value, str):
        return value
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return value.strftime("%Y-%m-%d 00:00:00")


def ts_bound(value: datetime | date | str, data_type: T.DataType | None = None) -> Column:
    """A timestamp literal of the same kind as the column it is compared with.

    A Python ``datetime`` literal is a zoned ``timestamp``; compared with a
    ``timestamp_ntz`` column it would be shifted by the session zone. Building
    the bound from text with the column's own type gives the same rows under
    every session zone, and keeps the comparison pushable to the scan.
    """
    text = F.lit(_as_text(value))
    if isinstance(data_type, T.TimestampType):
        return text.cast("timestamp")
    return F.to_timestamp_ntz(text)


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    lowered = name.lower()
    for field in df.schema.fields:
        if field.name.lower() == lowered:
            return field.dataType
    return None


def missing(col: str) -> Column:
    return F.col(col).isNull()


def outside_period(col: str, start: Column, end: Column) -> Column:
    """True when the value is outside ``[start, end)``; false when it is NULL."""
    c = F.col(col)
    return F.coalesce(c.isNotNull() & ((c < start) | (c >= end)), F.lit(False))


def before(later: str, earlier: str) -> Column:
    """True when ``later < earlier``; false when either side is NULL."""
    a, b = F.col(later), F.col(earlier)
    return F.coalesce(a.isNotNull() & b.isNotNull() & (a < b), F.lit(False))


def duration_seconds(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero; NULL if either is.

    The difference of two timestamps is a day-time interval computed without
    any time zone (for ``timestamp_ntz`` it is wall-clock arithmetic), so the
    result does not depend on the session zone; ``timestampdiff`` on NTZ
    values converts them to zoned instants and is off by an hour across a
    daylight-saving change. It is also cheaper: no zone lookup per row.
    """
    return (F.col(end) - F.col(start)).cast("interval second").cast("bigint")


def duration_minutes(start: str, end: str) -> Column:
    """Whole seconds between the two timestamps divided by 60.0, as double."""
    return duration_seconds(start, end) / F.lit(60.0)


def duration_minutes_decimal(start: str, end: str) -> Column:
    """The SQL-expression form: whole seconds ``/ 60.0`` (a decimal literal) is decimal."""
    return F.expr(
        f"CAST(CAST(`{end}` - `{start}` AS INTERVAL SECOND) AS BIGINT) / 60.0")


def flag_predicates(
    distance: str = C.DISTANCE,
    fare: str = C.FARE,
    total: str = C.TOTAL,
    passengers: str = C.PASSENGERS,
) -> list[tuple[str, Column]]:
    """The four non-blocking anomaly flags as (name, predicate)."""
    return [
        (C.IS_ZERO_DISTANCE, F.col(distance) == 0),
        (C.HAS_NEGATIVE_FARE, F.col(fare) < 0),
        (C.HAS_NEGATIVE_TOTAL, F.col(total) < 0),
        (C.IS_PASSENGER_COUNT_NULL, F.col(passengers).isNull()),
    ]


def quality_flags(
    distance: str = C.DISTANCE,
    fare: str = C.FARE,
    total: str = C.TOTAL,
    passengers: str = C.PASSENGERS,
) -> list[Column]:
    """The flags as named columns, kept on silver for analysis."""
    return [pred.alias(name) for name, pred in flag_predicates(distance, fare, total, passengers)]


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` when the denominator is positive, else NULL.

    ANSI mode raises on division by zero, so every ratio is guarded.
    """
    return F.when(denominator > 0, numerator / denominator)


def count_true(predicate: Column) -> Column:
    """Rows where the predicate is true; NULL counts as not matching; 0 on no rows."""
    return F.count_if(F.coalesce(predicate, F.lit(False)))
