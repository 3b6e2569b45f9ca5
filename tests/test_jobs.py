"""Jobs, publishing, audit and landing: the reference's local-pipeline cases."""

from __future__ import annotations

import dataclasses
import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs as J
from strata.sources import audit as A
from strata.sources import landing, publish, raw, storage
from tests.test_checks import RAW_SCHEMA

START, END = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def local_rows():
    return [
        (1, datetime(2026, 1, 10, 10), datetime(2026, 1, 10, 10, 20), 1, 2.5, 1, 2, 1, 15.0, 18.0),
        (1, datetime(2026, 2, 1, 0), datetime(2026, 2, 1, 0, 30), 2, 4.0, 3, 4, 1, 20.0, 24.0),
        (2, datetime(2026, 1, 15, 12), datetime(2026, 1, 15, 11, 50), None, 0.0, 5, 6, 2, -5.0, -6.0),
    ]


@pytest.fixture
def cfg(utc, tmp_path):
    tag = uuid.uuid4().hex[:8]
    return J.PipelineConfig(period_start=START, period_end=END,
                            source_file="trips_2026-01.parquet",
                            root=str(tmp_path / "root"),
                            bronze_schema=f"t_bronze_{tag}", silver_schema=f"t_silver_{tag}",
                            gold_schema=f"t_gold_{tag}")


def test_silver_job_counts_and_audit(utc, cfg):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA)
    J.job_bronze(utc, df, cfg)
    rec = J.job_silver(utc, cfg)
    assert (rec["raw_count"], rec["silver_count"], rec["quarantine_count"]) == (3, 1, 2)
    assert utc.table(cfg.silver_table).count() == 1
    assert utc.table(cfg.quarantine_table).count() == 2
    audit = {r["step"]: r for r in J.run_audit(utc, cfg).collect()}
    assert audit["silver"]["status"] == A.SUCCESS
    assert (audit["silver"]["raw_count"], audit["silver"]["silver_count"],
            audit["silver"]["quarantine_count"]) == (3, 1, 2)
    assert {"year", "month"} <= set(utc.table(cfg.silver_table).columns)


def test_missing_raw_file_fails_and_is_audited(utc, cfg, tmp_path):
    def missing():
        return raw.read_raw(utc, str(tmp_path / "nope.parquet"))

    with pytest.raises(FileNotFoundError):
        J.job_bronze(utc, missing, cfg)
    with pytest.raises(FileNotFoundError):
        J.run_pipeline(utc, missing, cfg)
    rows = {r["step"]: r for r in J.run_audit(utc, cfg).collect()}
    assert set(rows) == {"bronze", "raw_validation"}
    assert {(r["status"], r["error_type"]) for r in rows.values()} == {(A.FAILED, "FileNotFoundError")}


def test_stale_quarantine_is_not_visible(utc, cfg):
    J.job_bronze(utc, utc.createDataFrame(local_rows(), RAW_SCHEMA), cfg)
    J.job_silver(utc, cfg)
    assert utc.table(cfg.quarantine_table).count() == 2
    J.job_bronze(utc, utc.createDataFrame(local_rows()[:1], RAW_SCHEMA), cfg)
    rec = J.job_silver(utc, cfg)
    assert (rec["raw_count"], rec["silver_count"], rec["quarantine_count"]) == (1, 1, 0)
    assert utc.table(cfg.quarantine_table).count() == 0
    assert utc.table(cfg.silver_table).count() == 1


def test_reconcile_raises_with_three_counts():
    with pytest.raises(RuntimeError, match="1 kept and 1 rejected of 3"):
        J.reconcile({"rows": 3, "silver": 1, "quarantine": 1})


def test_raw_gate_stops_the_pipeline(utc, cfg):
    bad = utc.createDataFrame(
        [(1, None, datetime(2026, 1, 10, 10, 20), 1, 2.5, 1, 2, 1, 15.0, 18.0)], RAW_SCHEMA)
    with pytest.raises(J.GateClosed, match="raw validation"):
        J.run_pipeline(utc, bad, cfg)
    steps = {r["step"]: r["status"] for r in J.run_audit(utc, cfg).collect()}
    assert steps == {"raw_validation": A.FAILED}
    assert not utc.catalog.tableExists(cfg.bronze_table)


def test_silver_gate_stops_before_anything_is_published(utc, cfg, monkeypatch):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA)
    monkeypatch.setattr(J, "silver_gate", lambda staged: ["dropoff_before_pickup"])
    with pytest.raises(J.GateClosed, match="silver validation"):
        J.run_pipeline(utc, df, cfg)
    steps = {r["step"]: r["status"] for r in J.run_audit(utc, cfg).collect()}
    assert steps["silver"] == A.FAILED and "gold_daily" not in steps
    assert not utc.catalog.tableExists(cfg.silver_table)


def test_silver_gate_finds_what_was_observed():
    seen = {"rows": 3, "silver": 1, "quarantine": 1, "dropoff_before_pickup": 0, "pickup_outside_period": 2}
    staged = publish.Staged("p", seen, utc_schema(), ())
    assert J.silver_gate(staged) == ["reconciliation", "pickup_outside_period"]


def utc_schema():
    from pyspark.sql import types as T

    from strata.functions import contract as C
    return T.StructType([T.StructField(c, T.StringType()) for c in C.EXPECTED_SILVER_COLUMNS])


def test_rows_lost_before_bronze_stop_the_pipeline(utc, cfg):
    with pytest.raises(J.GateClosed, match="raw input had 4"):
        J.job_bronze(utc, utc.createDataFrame(local_rows(), RAW_SCHEMA), cfg, expected_rows=4)


def test_raw_gate_may_only_report(utc, cfg):
    bad = utc.createDataFrame([(1, None, datetime(2026, 1, 10), 1, 2.5, 1, 2, 1, 15.0, 18.0), *local_rows()], RAW_SCHEMA)
    cfg.raw_gate = "report"
    J.run_pipeline(utc, bad, cfg)
    assert utc.table(cfg.quarantine_table).count() == 3


@pytest.mark.parametrize("change", ["fare_amount AS fare_amt", "CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount",
                                    "fare_amount, 7 AS extra", None])
def test_second_bronze_run_replaces_the_schema(utc, cfg, change):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA)
    J.job_bronze(utc, df, cfg)
    others = [c for c in df.columns if c != "fare_amount"]
    second = df.selectExpr(*others, *([change] if change else [])) if change is None or "," not in change \
        else df.selectExpr(*others, *[x.strip() for x in change.split(", ")]) if "extra" in change \
        else df.selectExpr(*others, change)
    J.job_bronze(utc, second, cfg)
    got = utc.table(cfg.bronze_table)
    assert got.columns == [*second.columns, "_source_file"]
    assert [t for _, t in got.dtypes[:-1]] == [t for _, t in second.dtypes]
    assert sorted(got.drop("_source_file").collect(), key=str) == sorted(second.collect(), key=str)


def test_one_month_writes_few_quarantine_files(utc, cfg):
    rows = [(1, datetime(2020 + i % 5, 1 + i % 12, 3), datetime(2026, 1, 1), 1, 1.0, 1, 2, 1, 1.0, 1.0)
            for i in range(240)]
    rec = J.job_silver(utc, cfg, utc.createDataFrame(rows, RAW_SCHEMA).repartition(8)
                       .selectExpr("*", "'f' AS _source_file"))
    files = utc.table(cfg.quarantine_table).inputFiles()
    assert rec["quarantine_count"] == 240 and len(files) <= 60  # one for each of the 60 months


def test_derived_names_in_the_input_are_refused_up_front(utc, cfg):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA).selectExpr("*", "true AS is_zero_distance", "1999 AS year")
    with pytest.raises(ValueError, match="is_zero_distance, year"):
        J.job_silver(utc, cfg, df.selectExpr("*", "'f' AS _source_file"))


def test_nothing_observed_is_needed_for_an_empty_version(utc, cfg):
    J.ensure_layers(utc, cfg)
    schema = utc.range(1).schema
    with pytest.raises(FileNotFoundError):
        publish.point_table(utc, f"{cfg.bronze_schema}.gone", f"{cfg.root}/nowhere", schema, rows=3)
    publish.point_table(utc, f"{cfg.bronze_schema}.none", f"{cfg.root}/empty", schema, rows=0)
    assert utc.table(f"{cfg.bronze_schema}.none").count() == 0


def test_unreadable_landing_files_raise(utc):
    with pytest.raises(ValueError, match="scheme abfss"):
        landing.open_uri("abfss://box@account/x.parquet")


def test_audit_of_a_broken_folder_raises(utc, tmp_path):
    assert A.read_audit(utc, str(tmp_path / "never")).count() == 0


def test_full_pipeline_and_history(utc, cfg):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA)
    audit = J.run_pipeline(utc, df, cfg)
    assert {r["step"] for r in audit.collect()} == {
        "raw_validation", "bronze", "silver", "gold_daily", "gold_monthly", "gold_quality"}
    assert utc.table(cfg.daily_table).count() == 1
    J.job_bronze(utc, df, J.PipelineConfig(**{**cfg.__dict__, "run_id": "second"}))
    hist = A.table_history(A.read_audit(utc, cfg.audit_path)).filter(
        F.col("table_name") == cfg.bronze_table).orderBy("version").collect()
    assert [h["version"] for h in hist] == [0, 1]


def test_full_refresh_is_repeatable(utc, cfg):
    df = utc.createDataFrame(local_rows(), RAW_SCHEMA)
    J.job_bronze(utc, df, cfg)
    first = sorted(utc.table(cfg.bronze_table).collect())
    J.job_bronze(utc, df, cfg.__class__(**{**cfg.__dict__, "run_id": "again"}))
    assert sorted(utc.table(cfg.bronze_table).collect()) == first


def test_publish_atomic_refuses_wrong_count(utc, cfg):
    J.ensure_layers(utc, cfg)
    name = f"{cfg.bronze_schema}.atomic"
    with pytest.raises(RuntimeError, match="refusing"):
        publish.publish_atomic(utc.range(3), name, cfg.root, expected_rows=4)
    assert not utc.catalog.tableExists(name)
    publish.publish_atomic(utc.range(3), name, cfg.root, expected_rows=3)
    assert utc.table(name).count() == 3


def test_partitioned_publish_clears_stale_month(utc, tmp_path):
    path = str(tmp_path / "layout")
    df = utc.createDataFrame(
        [(datetime(2026, 1, 5),), (datetime(2026, 2, 5),)], "tpep_pickup_datetime timestamp_ntz")
    publish.publish_partitioned(df, path, months=[(2026, 1), (2026, 2)])
    assert raw.read_partitioned(utc, path).count() == 2
    m = publish.publish_partitioned(df.filter("month(tpep_pickup_datetime) = 1"),
                                    path, months=[(2026, 1), (2026, 2)])
    assert m["cleared"] == [(2026, 2)]
    out = raw.read_partitioned(utc, path)
    assert out.count() == 1 and out.first()["month"] == 1


def test_months_between():
    assert publish.months_between("2025-12-01 00:00:00", "2026-02-01 00:00:00") == [(2025, 12), (2026, 1)]
    assert publish.months_between("2026-01-15", "2026-02-02") == [(2026, 1), (2026, 2)]


def test_optional_count(utc, tmp_path):
    assert raw.row_count(utc, str(tmp_path / "none"), required=False) == 0
    with pytest.raises(FileNotFoundError):
        raw.row_count(utc, str(tmp_path / "none"), required=True)


def test_schemas_created_and_listed(utc, cfg):
    J.ensure_layers(utc, cfg)
    names = {r["namespace"] for r in publish.list_schemas(utc, "t_%").collect()}
    assert {cfg.bronze_schema, cfg.silver_schema, cfg.gold_schema} <= names


def test_landing_checks(utc, tmp_path):
    good = tmp_path / "good.parquet"
    utc.range(3).toPandas().to_parquet(good)
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    (tmp_path / "tiny.parquet").write_bytes(b"PAR1")
    checked = landing.check_landing(landing.list_files(utc, str(tmp_path / "*.parquet")))
    valid = {os.path.basename(r["path"]): r["valid"] for r in checked.collect()}
    assert valid == {"good.parquet": True, "bad.parquet": False, "tiny.parquet": False}
    size = good.stat().st_size
    manifest = utc.createDataFrame(
        [(r["path"], size + (0 if r["path"].endswith("good.parquet") else 1)) for r in checked.collect()],
        "path string, announced_length long")
    acc = {os.path.basename(r["path"]): r["accepted"] for r in
           landing.check_lengths(checked, manifest).collect()}
    assert acc == {"good.parquet": True, "bad.parquet": False, "tiny.parquet": False}
    wrong = utc.createDataFrame([(r["path"], 1) for r in checked.collect()],
                                "path string, announced_length long")
    assert landing.check_lengths(checked, wrong).filter("accepted").count() == 0
    landed = checked.filter("valid").select("path")
    assert landing.new_files(checked, landed).count() == 0
    assert landing.new_files(checked, landed.limit(0)).count() == 1


def test_work_root_is_under_checkpoint_dir(utc):
    root = storage.work_root(utc)
    assert root.startswith(storage.checkpoint_root(utc))


def _marts(spark, cfg):
    return [sorted(map(tuple, spark.table(t).collect())) for t in (cfg.daily_table, cfg.monthly_table, cfg.quality_table)]


def _twice(df):
    return df.unionByName(df)


def _no_key(df):
    return df.unionByName(df.limit(1).withColumn(df.columns[0], F.lit(None).cast(df.schema[0].dataType))
                          .withColumn(df.columns[1], F.lit(0).cast(df.schema[1].dataType)))


def _trip_less(df):
    return df.withColumn(df.columns[1], F.col(df.columns[1]) - 1)


@pytest.mark.parametrize("mart,step", [("daily_mart", "gold_daily"), ("monthly_mart", "gold_monthly"),
                                       ("quality_mart", "gold_quality")])
@pytest.mark.parametrize("broken,rule", [(_twice, "unique_"), (_no_key, "not_null_"), (_trip_less, "reconciliation")])
def test_gold_gate_hides_a_broken_mart(utc, cfg, monkeypatch, mart, step, broken, rule):
    if (mart, broken) == ("quality_mart", _trip_less):
        pytest.skip("the quality mart holds no trips")
    J.run_pipeline(utc, utc.createDataFrame(local_rows()[:1], RAW_SCHEMA), cfg)
    before = _marts(utc, cfg)
    right = getattr(J.marts, mart)
    monkeypatch.setattr(J.marts, mart, lambda df: broken(right(df)))
    again = dataclasses.replace(cfg, run_id="second")
    good = [(1, datetime(2026, 1, 20, 10), datetime(2026, 1, 20, 10, 20), 1, 2.5, 1, 2, 1, 15.0, 18.0)]
    with pytest.raises(J.GateClosed, match=f"gold validation failed.*{rule}"):
        J.run_pipeline(utc, utc.createDataFrame(local_rows()[:1] + good, RAW_SCHEMA), again)
    assert _marts(utc, cfg) == before  # not one of the three has changed
    steps = {r["step"]: r["status"] for r in J.run_audit(utc, again).collect()}
    assert steps[step] == A.FAILED and A.SUCCESS not in [v for k, v in steps.items() if k.startswith("gold")]


def test_silver_and_quarantine_change_by_one_switch(utc, cfg, monkeypatch):
    def seen():
        return utc.table(cfg.silver_table).count(), utc.table(cfg.quarantine_table).count()

    J.job_bronze(utc, utc.createDataFrame(local_rows(), RAW_SCHEMA), cfg)
    J.job_silver(utc, cfg)
    assert seen() == (1, 2)
    opened = utc.table(cfg.quarantine_table)
    switch, states = publish.point_table, []

    def watched(spark, name, *args, **kwargs):
        states.append((name, seen()))
        switch(spark, name, *args, **kwargs)
        states.append((name, seen()))

    J.job_bronze(utc, utc.createDataFrame(local_rows()[:1] * 3, RAW_SCHEMA), cfg)
    monkeypatch.setattr(publish, "point_table", watched)
    J.job_silver(utc, cfg)
    # old with old, then new with new, and no other switch
    assert states == [(cfg.split_table, (1, 2)), (cfg.split_table, (3, 0))]
    assert opened.count() == 2  # a reader of the old version finishes with it

    def failing(*args, **kwargs):
        raise OSError("the catalog is gone")

    monkeypatch.setattr(publish, "point_table", failing)
    with pytest.raises(OSError):
        J.job_silver(utc, cfg, bronze=utc.createDataFrame(local_rows(), RAW_SCHEMA).withColumn("_source_file", F.lit("f")))
    assert seen() == (3, 0)


def test_silver_views_follow_the_columns_of_the_version(utc, cfg):
    J.job_bronze(utc, utc.createDataFrame(local_rows(), RAW_SCHEMA), cfg)
    J.job_silver(utc, cfg)
    plain = utc.table(cfg.silver_table).columns
    J.job_bronze(utc, utc.createDataFrame(local_rows(), RAW_SCHEMA).withColumn("tip_amount", F.lit(1.0)), cfg)
    J.job_silver(utc, cfg)
    assert set(utc.table(cfg.silver_table).columns) == {*plain, "tip_amount"}
    assert "_layer" not in utc.table(cfg.quarantine_table).columns
    J.job_bronze(utc, utc.createDataFrame([], RAW_SCHEMA), cfg)
    J.job_silver(utc, cfg)
    assert utc.table(cfg.silver_table).columns == plain and utc.table(cfg.silver_table).count() == 0


def test_null_staging_keys_close_the_silver_gate():
    seen = {"rows": 1, "silver": 1, "quarantine": 0, "dropoff_before_pickup": 0, "pickup_outside_period": 0,
            "null__source_file": 1}
    assert J.silver_gate(publish.Staged("p", seen, utc_schema(), ())) == ["null__source_file"]


def test_months_are_replaced_by_one_switch(utc, cfg):
    J.ensure_layers(utc, cfg)
    name, months = f"{cfg.silver_schema}.by_month", [(2026, 1), (2026, 2)]
    rows = utc.createDataFrame([(datetime(2025, 12, 5), 1), (datetime(2026, 1, 5), 2), (datetime(2026, 2, 5), 3)],
                               "tpep_pickup_datetime timestamp_ntz, n int")

    def seen():
        return sorted(r["n"] for r in utc.table(name).collect())

    publish.publish_months(rows, name, cfg.root, months=months)
    assert seen() == [1, 2, 3]
    opened = utc.table(name)
    # the write fails, then the count is not the announced one: nothing changes
    bad = rows.withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("torn"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="torn"):
        publish.publish_months(bad.withColumn("n", F.col("n").cast("int")), name, cfg.root, months=months)
    with pytest.raises(RuntimeError, match="stays as it is"):
        publish.publish_months(rows.filter("n = 2"), name, cfg.root, months=months, expected_rows=2)
    assert seen() == [1, 2, 3]
    # February became empty, December is not this run's
    new = rows.filter("n = 2").withColumn("n", F.lit(20)).withColumn("more", F.lit("x"))
    done = publish.publish_months(new, name, cfg.root, months=months, expected_rows=1)
    assert (done["months"], done["cleared"]) == ([202601], [202602])
    assert seen() == [1, 20]
    assert {(r["n"], r["more"], r["year"], r["month"]) for r in utc.table(name).collect()} == \
        {(1, None, 2025, 12), (20, "x", 2026, 1)}
    assert opened.count() == 3
    publish.publish_months(rows.limit(0), name, cfg.root, months=[(2025, 12), *months])
    assert utc.table(name).count() == 0


def test_expiry_keeps_a_stated_number_of_versions(utc, cfg):
    df = utc.createDataFrame(local_rows()[:1], RAW_SCHEMA)
    for i in range(5):
        J.job_bronze(utc, df, dataclasses.replace(cfg, run_id=f"run{i}"))
        if i == 3:
            opened = utc.table(cfg.bronze_table)
    assert len(storage.folders(utc, cfg.versions(cfg.bronze_table))) == 5
    assert len(J.expire(utc, cfg)) == 3
    assert len(storage.folders(utc, cfg.versions(cfg.bronze_table))) == 2
    assert opened.count() == 1 and utc.table(cfg.bronze_table).count() == 1
    assert J.expire(utc, cfg) == []
    # newer folders that were never published do not push out what a name shows
    for i in range(3):
        publish.stage(df, f"{cfg.versions(cfg.bronze_table)}/failed{i}")
    J.expire(utc, cfg)
    assert utc.table(cfg.bronze_table).count() == 1
