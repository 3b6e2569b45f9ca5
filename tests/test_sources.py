"""Sinks and inspection: overwrite replaces the schema, detail and footers are right."""

from __future__ import annotations

import os
import uuid

import pyarrow.parquet as pq

from strata.sources import inspect as I
from strata.sources import publish, storage
from tests.conftest import SF_SMALL


def test_publish_table_replaces_rows_and_schema(spark):
    schema = f"t_src_{uuid.uuid4().hex[:8]}"
    publish.ensure_schemas(spark, [schema])
    name, path = f"{schema}.t", storage.new_dir(spark, "tables", "t")
    publish.publish_table(spark.range(5).withColumnRenamed("id", "a"), name, path)
    assert spark.table(name).columns == ["a"] and spark.table(name).count() == 5
    publish.publish_table(spark.range(3).selectExpr("id AS b", "id * 2 AS c"), name, path)
    assert spark.table(name).columns == ["b", "c"] and spark.table(name).count() == 3


def test_table_detail_counts_files_and_bytes(spark):
    schema = f"t_src_{uuid.uuid4().hex[:8]}"
    publish.ensure_schemas(spark, [schema])
    name, path = f"{schema}.d", storage.new_dir(spark, "tables", "d")
    publish.publish_table(spark.range(1000).repartition(3), name, path)
    row = I.table_detail(spark, name).first()
    local = path.replace("file:", "")
    files = [f for f in os.listdir(local) if f.endswith(".parquet")]
    assert row["format"] == "parquet" and row["numFiles"] == len(files) == 3
    assert row["sizeInBytes"] == sum(os.path.getsize(os.path.join(local, f)) for f in files)


def test_inspect_matches_the_footer(spark):
    path = os.path.join(SF_SMALL, "orders.parquet")
    meta = pq.ParquetFile(path).metadata
    rows = I.inspect(spark, path).collect()
    assert len(rows) == meta.num_columns
    assert {r["num_rows"] for r in rows} == {meta.num_rows}
    assert {r["num_row_groups"] for r in rows} == {meta.num_row_groups}
    assert [r["field_name"] for r in sorted(rows, key=lambda r: r["position"])][0] == "o_orderkey"
