"""Bronze lineage and the silver / quarantine split.

The split is a pure row-wise plan: each output is one Filter on the four
blocking rules and one Project adding the duration and the four flags under
lowercased names. It has no shuffle, so it scales linearly with the number of
input splits, and the same function runs unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.functions import predicates as P
from strata.functions.names import require_distinct, require_text

LAYER_COLUMN = "_layer"
SILVER = "silver"
QUARANTINE = "quarantine"
# Every column that the split, its label or the published layout adds.
DERIVED_COLUMNS = (C.DURATION_COLUMN, C.IS_ZERO_DISTANCE, C.HAS_NEGATIVE_FARE, C.HAS_NEGATIVE_TOTAL,
                   C.IS_PASSENGER_COUNT_NULL, C.REASON_COLUMN, LAYER_COLUMN, "year", "month")


def add_lineage(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Add the ``_source_file`` lineage column.

    With a name, every row gets that literal (one landed file per run). With
    ``None`` the name comes from the scan's ``_metadata.file_name``, which is
    right when a directory of many files is read at once.
    """
    lineage = (F.col("_metadata.file_name") if source_file is None
               else F.lit(require_text(source_file, "the source file's name")))
    return df.select("*", lineage.alias(C.SOURCE_FILE_COLUMN))


@dataclass(frozen=True)
class SplitColumns:
    """Names of the trip columns the split reads."""

    pickup: str = C.PICKUP
    dropoff: str = C.DROPOFF
    distance: str = C.DISTANCE
    fare: str = C.FARE
    total: str = C.TOTAL
    passengers: str = C.PASSENGERS


def blocking_rules(
    df: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns = SplitColumns(),
) -> list[tuple[str, Column]]:
    """The four blocking rules in reason order; each is never NULL."""
    pickup_type = P.column_type(df, cols.pickup)
    start = P.ts_bound(period_start, pickup_type)
    end = P.ts_bound(period_end, pickup_type)
    return [
        (C.MISSING_PICKUP, P.missing(cols.pickup)),
        (C.MISSING_DROPOFF, P.missing(cols.dropoff)),
        (C.PICKUP_OUTSIDE_PERIOD, P.outside_period(cols.pickup, start, end)),
        (C.DROPOFF_BEFORE_PICKUP, P.before(cols.dropoff, cols.pickup)),
    ]


def _outputs(
    bronze: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns,
) -> tuple[list[tuple[str, Column]], list[Column]]:
    """Rules in reason order and the output columns (lowercased names,
    duration, flags), computed once from the bronze schema."""
    P.check_period(period_start, period_end)
    names = bronze.columns
    require_distinct([*names, *DERIVED_COLUMNS], "the split adds columns of its own")
    rules = blocking_rules(bronze, period_start, period_end, cols)
    out = [F.col(f"`{n}`").alias(n.lower()) for n in names]
    out.append(P.duration_minutes(cols.pickup, cols.dropoff).alias(C.DURATION_COLUMN))
    out.extend(P.quality_flags(cols.distance, cols.fare, cols.total, cols.passengers))
    return rules, out


def _any(rules: list[tuple[str, Column]]) -> Column:
    cond = rules[0][1]
    for _, pred in rules[1:]:
        cond = cond | pred
    return cond


def reason(rules: list[tuple[str, Column]]) -> Column:
    """Broken rules in fixed order joined by ``;`` (``concat_ws`` skips NULLs)."""
    return F.concat_ws(C.REASON_SEPARATOR, *[F.when(pred, F.lit(name)) for name, pred in rules])


def silver_rows(
    bronze: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns = SplitColumns(),
) -> DataFrame:
    """Rows that break no blocking rule, with duration and flags (one Filter + Project)."""
    rules, out = _outputs(bronze, period_start, period_end, cols)
    return bronze.where(~_any(rules)).select(*out)


def quarantine_rows(
    bronze: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns = SplitColumns(),
) -> DataFrame:
    """Rows that break a blocking rule, with ``_quarantine_reason``."""
    rules, out = _outputs(bronze, period_start, period_end, cols)
    return bronze.where(_any(rules)).select(*out, reason(rules).alias(C.REASON_COLUMN))


def split(
    bronze: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns = SplitColumns(),
) -> tuple[DataFrame, DataFrame]:
    """Return ``(silver, quarantine)`` with lowercased names.

    Silver holds rows breaking no blocking rule; quarantine holds the others
    with ``_quarantine_reason``. Rules never evaluate to NULL, so every row
    lands in exactly one of the two.
    """
    return (silver_rows(bronze, period_start, period_end, cols),
            quarantine_rows(bronze, period_start, period_end, cols))


def labelled(
    bronze: DataFrame,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    cols: SplitColumns = SplitColumns(),
) -> DataFrame:
    """Both outputs in one DataFrame with a ``_layer`` column.

    This lets a job write silver and quarantine from a single scan of bronze
    (one write partitioned by ``_layer``) instead of scanning it twice. The
    layer is NULL only if a rule evaluates to NULL, which reconciliation then
    catches as a lost row.
    """
    rules, out = _outputs(bronze, period_start, period_end, cols)
    bad = _any(rules)
    return bronze.select(
        *out,
        F.when(bad, F.lit(QUARANTINE)).when(~bad, F.lit(SILVER)).alias(LAYER_COLUMN),
        F.when(bad, reason(rules)).alias(C.REASON_COLUMN),
    )
