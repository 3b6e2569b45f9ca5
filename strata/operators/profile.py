"""Profiling: overview, per-column NULLs and rule counts, each in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.functions.predicates import count_true


def overview(
    df: DataFrame,
    pickup: str = C.PICKUP,
    dropoff: str = C.DROPOFF,
    source_file: str | None = C.SOURCE_FILE_COLUMN,
) -> DataFrame:
    """Row count, pickup and dropoff range and distinct source files."""
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.min(pickup).alias("min_pickup"),
        F.max(pickup).alias("max_pickup"),
        F.min(dropoff).alias("min_dropoff"),
        F.max(dropoff).alias("max_dropoff"),
    ]
    if source_file and source_file in df.columns:
        aggs.append(F.count_distinct(source_file).alias("source_files"))
    return df.agg(*aggs)


def null_profile(df: DataFrame, columns: Sequence[str] = C.PROFILE_COLUMNS) -> DataFrame:
    """Per column: NULL count and NULL percent (0 when the table is empty).

    Columns absent from ``df`` are skipped. One aggregate, then one row per
    column through a generator.
    """
    present = [c for c in columns if c in df.columns]
    total = F.count(F.lit(1)).alias("_total")
    wide = df.agg(total, *[F.count_if(F.col(c).isNull()).alias(f"n{i}")
                           for i, c in enumerate(present)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(present)
    ])
    pct = F.when(
        F.col("_total") > 0,
        F.col("null_count").cast("double") / F.col("_total").cast("double") * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    return wide.select("_total", F.inline(rows)).select(
        "position", "column_name", "null_count", pct.alias("null_percent")
    )


# Profile rule names and the predicates they count.
def profile_rule_predicates(
    distance: str = C.DISTANCE,
    fare: str = C.FARE,
    total: str = C.TOTAL,
    pickup: str = C.PICKUP,
    dropoff: str = C.DROPOFF,
):
    return [
        ("trip_distance_negative", F.col(distance) < 0),
        ("trip_distance_zero", F.col(distance) == 0),
        ("fare_amount_negative", F.col(fare) < 0),
        ("total_amount_negative", F.col(total) < 0),
        ("dropoff_before_pickup", F.col(dropoff) < F.col(pickup)),
    ]


def rule_profile(df: DataFrame) -> DataFrame:
    """The five profile rule counts as (rule, row_count) rows, one aggregate."""
    preds = profile_rule_predicates()
    wide = df.agg(*[count_true(p).alias(f"r{i}") for i, (_, p) in enumerate(preds)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("row_count"))
        for i, (name, _) in enumerate(preds)
    ])
    return wide.select(F.inline(rows))


def count_rules(df: DataFrame, rules: Sequence[tuple[str, object]]) -> DataFrame:
    """Generic conditional counts: one column per named predicate, one row."""
    return df.agg(*[count_true(pred).alias(name) for name, pred in rules])
