"""Physical-plan checks: pruning, pushdown, join strategy, single scans, no nested loops."""

from __future__ import annotations

import re

import pytest

from strata.functions import contract as C
from strata.operators import checks, joins, marts, reports, silver
from strata.plans import fixtures as X
from strata.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.plan_util import plan


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    """The trip fixture written once as a plain Parquet fact table, plus one extra column."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("raw") / "trips")
    X.trips(spark, SF_SMALL).withColumn(C.TIP, F.lit(1.0)).write.parquet(path)
    return path


def _read_schema(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*)", text)


def test_period_filter_reaches_the_scan_and_columns_are_pruned(spark, raw_path):
    df = marts.daily_study(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    text = plan(df, "formatted")
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text
    assert "LessThan(tpep_pickup_datetime" in text
    (schema,) = _read_schema(text)
    assert C.TIP not in schema and C.FARE not in schema and "VendorID" not in schema


def test_raw_checks_scan_once_and_skip_unneeded_columns(spark, raw_path):
    df = checks.check_raw(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    assert plan(df).count("FileScan parquet") == 1
    (schema,) = _read_schema(plan(df, "formatted"))
    assert C.TIP not in schema


def test_split_has_no_shuffle(spark, raw_path):
    s, q = silver.split(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    for df in (s, q):
        text = plan(df)
        assert "Exchange" not in text and text.count("FileScan parquet") == 1


def test_daily_mart_aggregates_partially_before_the_shuffle(spark, raw_path):
    s, _ = silver.split(silver.add_lineage(spark.read.parquet(raw_path), "f"),
                        X.PERIOD_START, X.PERIOD_END)
    text = plan(marts.daily_mart(marts.enrich(marts.stage(s))))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1


def test_quality_mart_is_one_aggregate_without_union(spark, raw_path):
    s, _ = silver.split(silver.add_lineage(spark.read.parquet(raw_path), "f"),
                        X.PERIOD_START, X.PERIOD_END)
    daily = marts.daily_mart(marts.enrich(marts.stage(s)))
    text = plan(marts.quality_mart(daily))
    assert "Union" not in text and "Generate" in text
    assert "Union" in plan(marts.quality_mart_union(daily))


def test_zone_join_strategies(spark, raw_path):
    fact = joins.trips_for_join(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    dim = joins.zone_dim(spark)
    b = plan(joins.zone_join(fact, dim, "broadcast"))
    m = plan(joins.zone_join(fact, dim, "merge"))
    assert "BroadcastHashJoin" in b and "LeftOuter" in b
    assert "SortMergeJoin" in m and "LeftOuter" in m


def test_broadcast_beyond_the_bound_raises(spark, raw_path):
    fact = joins.trips_for_join(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    with pytest.raises(ValueError, match="above the broadcast bound"):
        joins.zone_join(fact, joins.zone_dim(spark), "broadcast", max_rows=10)


def test_merge_join_spreads_each_zone(spark):
    fact = spark.range(4000).selectExpr("CAST(id % 3 + 1 AS INT) AS pickup_location_id", "id AS total_amount")
    out = joins.zone_join(fact, joins.zone_dim(spark), "merge", salt=8)
    assert out.count() == 4000 and out.filter("location_id IS NULL").count() == 0
    assert "_salt" in plan(out) and out.columns == ["pickup_location_id", "total_amount", "location_id", "zone_label"]


@pytest.mark.parametrize("key", ["checkpoint_report", "check_silver", "check_silver_verdict", "rule_catalog",
                                 "layer_counts", "check_mart_reconciles", "check_not_null"])
def test_registered_reports_read_the_trips_once(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    assert text.count("lineitem.parquet") == 1


def test_reports_use_no_nested_loop_join(spark, raw_path):
    b = silver.add_lineage(spark.read.parquet(raw_path), "f")
    s, q = silver.split(b, X.PERIOD_START, X.PERIOD_END)
    for df in (reports.checkpoint_report(b, s, q, X.PERIOD_START, X.PERIOD_END),
               checks.layer_counts(b, s, q),
               checks.mart_reconciles(marts.stage(s), marts.daily_mart(marts.enrich(marts.stage(s))))):
        text = plan(df)
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_counts_read_no_data_columns(spark, raw_path):
    df = spark.read.parquet(raw_path)
    text = plan(checks.layer_counts(df, df, df), "formatted")
    assert set(_read_schema(text)) == {"struct<>"}


def test_labelled_split_is_one_scan(spark, raw_path):
    lab = silver.labelled(spark.read.parquet(raw_path), X.PERIOD_START, X.PERIOD_END)
    text = plan(reports.layer_counts_one_pass(lab))
    assert text.count("FileScan parquet") == 1


def test_a_month_of_the_layout_reads_its_folder_only(spark):
    text = plan(QUERIES["scan_partitioned_month"](spark, SF_SMALL), "formatted")
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "(year" in filters and "(month" in filters


def test_merge_salt_follows_the_row_not_its_place(spark):
    fact = spark.range(400).selectExpr("CAST(id % 3 + 1 AS INT) AS pickup_location_id", "id % 37 / 4.0D AS total_amount")
    dim = joins.zone_dim(spark)

    def dealt(df):
        out = joins.zone_join(df, dim, "merge")
        return sorted(map(tuple, out.collect()))

    assert dealt(fact) == dealt(fact.repartition(7).orderBy("total_amount")) == sorted(
        map(tuple, joins.zone_join(fact, dim, "auto").collect()))
    assert "monotonically_increasing_id" not in plan(joins.zone_join(fact, dim, "merge"))
