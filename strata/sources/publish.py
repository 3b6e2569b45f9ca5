"""Sinks: table overwrite, versioned atomic publish, partitioned layout, schemas.

A published layer is a catalog view over an immutable version folder. A run
writes a complete new version, the caller checks its counts (taken with an
``Observation`` during that same write), and only then the view is replaced by
one over the new folder. Readers therefore see the old or the
new version, never a partial one, and a version can never contain stale rows
from an earlier run. Nothing is copied or renamed, so this works unchanged on
object stores.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import contract as C
from strata.sources import storage

COMPRESSION = "snappy"


def ensure_schemas(
    spark: SparkSession,
    names: Sequence[str],
    comment: str = "medallion layer",
    root: str | None = None,
) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` for each name, located under the work root."""
    root = root or storage.work_root(spark)
    for name in names:
        location = posixpath.join(root, f"{name}.db")
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS `{name}` COMMENT '{comment}' LOCATION '{location}'"
        )


def list_schemas(spark: SparkSession, like: str) -> DataFrame:
    """Schemas whose name matches a SQL LIKE pattern (column ``namespace``)."""
    return spark.sql("SHOW SCHEMAS").filter(F.col("namespace").like(like))


def publish_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Overwrite a table, schema included (full refresh); external at ``path``.

    Never call this with a plan that reads the same table: the overwrite
    deletes the files it would read.
    """
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .option("compression", COMPRESSION)
        .option("path", path)
        .saveAsTable(name)
    )


@dataclass(frozen=True)
class Staged:
    """A complete, not yet published version and the metrics of its write."""

    path: str
    metrics: dict
    schema: T.StructType
    partition_by: tuple[str, ...]


def stage(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    metrics: Sequence = (),
    rebalance: bool = False,
) -> Staged:
    """Write ``df`` once to a fresh folder and return it with observed metrics.

    A partitioned write stays map-only by default: Spark sorts each task's
    rows by the partition columns and writes one file per partition value the
    task holds, so there is no shuffle and a partition holding a large share
    of the rows cannot skew anything. When the input is not clustered by the
    partition columns (many partitions per task, many small files), pass
    ``rebalance=True``: a REBALANCE hint lets AQE group each partition into
    few tasks and split a heavy one, at the cost of one shuffle.

    Metrics are observed in the final (write) stage, where Spark merges each
    partition's metrics once even when tasks are retried.
    """
    obs = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    observed = df.observe(obs, rows, *metrics)
    writer = observed.write.mode("errorifexists").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return Staged(path, dict(obs.get), observed.schema, tuple(partition_by))


def point_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    rows: int | None = None,
) -> None:
    """Make ``name`` read the version at ``path``, with that version's columns.

    The name is a view over the version's folder, and ``CREATE OR REPLACE VIEW``
    is one catalog change: a reader has the old version with its columns or the
    new one with its own, never none and never a mixture. A folder that is not
    there is accepted only when the write was seen to have no rows.
    """
    if rows == 0:
        # a file that holds the columns, as a write without rows may leave none
        spark.createDataFrame([], schema).write.mode("append").parquet(path)
    elif not storage.exists(spark, path):
        raise FileNotFoundError(f"no version at {path} for {name}: {rows} rows were expected")
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a name that an earlier release made a table
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")


def publish(spark: SparkSession, name: str, staged: Staged, subpath: str | None = None,
            drop: Sequence[str] = (), rows: int | None = None) -> None:
    """Point ``name`` at a staged version (optionally one sub-folder of it).

    ``rows`` is the number of rows observed in that part of the write.
    """
    path = posixpath.join(staged.path, subpath) if subpath else staged.path
    gone = set(drop)
    data = [f for f in staged.schema.fields if f.name not in gone and f.name not in staged.partition_by]
    parts = [f for f in staged.schema.fields if f.name not in gone and f.name in staged.partition_by]
    observed = staged.metrics["rows"] if rows is None else rows
    point_table(spark, name, path, T.StructType(data + parts), observed)


def publish_parts(spark: SparkSession, base: str, staged: Staged, parts: dict[str, tuple[str, Sequence[str]]]) -> None:
    """Publish one version under several names by one switch.

    ``base`` is pointed at the version, and each name of ``parts`` is a view over
    ``base``: the rows that meet a condition, without some columns. These views
    name no folder and follow the columns of ``base``, so after the first publish
    the switch of ``base`` is the only change, and all names show the same version
    at any moment.
    """
    publish(spark, base, staged)
    for name, (condition, without) in parts.items():
        text = f"SELECT * EXCEPT ({', '.join(without)}) FROM {base} WHERE {condition}"
        if view_text(spark, name) != text:
            if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
                spark.sql(f"DROP TABLE {name}")
            spark.sql(f"CREATE OR REPLACE VIEW {name} WITH SCHEMA EVOLUTION AS {text}")


def view_text(spark: SparkSession, name: str) -> str | None:
    """The query of a view, None where there is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()
    return found and found["data_type"]


def publish_atomic(
    df: DataFrame,
    name: str,
    table_root: str | None = None,
    expected_rows: int | None = None,
    partition_by: Sequence[str] = (),
) -> Staged:
    """Write a complete new version, check its row count, then switch ``name`` to it."""
    spark = df.sparkSession
    version = f"versions/{name}/{uuid.uuid4().hex}"
    root = table_root or storage.work_root(spark)
    staged = stage(df, posixpath.join(root, version), partition_by)
    if expected_rows is not None and staged.metrics["rows"] != expected_rows:
        raise RuntimeError(
            f"refusing to publish {name}: wrote {staged.metrics['rows']} rows, "
            f"expected {expected_rows}"
        )
    publish(spark, name, staged)
    return staged


def with_year_month(df: DataFrame, ts: str) -> DataFrame:
    """Derive the ``year``/``month`` partition columns from a timestamp."""
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def publish_partitioned(
    df: DataFrame,
    path: str,
    ts: str = C.PICKUP.lower(),
    months: Sequence[tuple[int, int]] = (),
    rebalance: bool = False,
) -> dict:
    """In-place ``year=/month=`` layout with dynamic partition overwrite.

    For folders that others read by path; a reader may see some months before
    and some after the run. Names whose readers must not are published by
    ``publish_months``.

    Only partitions present in ``df`` are replaced. Partitions listed in
    ``months`` (the months this run owns) that received no rows are deleted
    explicitly, since an overwrite with zero rows leaves them in place. The
    months written are observed during the write (a set bounded by the
    number of months), so no extra pass over the data is needed.
    """
    spark = df.sparkSession
    out = with_year_month(df, ts)
    obs = Observation()
    key = F.col("year") * 100 + F.col("month")
    if rebalance:
        out = out.hint("rebalance", "year", "month")
    (
        out.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(key).alias("months"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy("year", "month")
        .parquet(path)
    )
    metrics = dict(obs.get)
    written = set(metrics["months"] or [])
    cleared = []
    for y, m in months:
        if y * 100 + m not in written:
            if storage.delete(spark, posixpath.join(path, f"year={y}", f"month={m}")):
                cleared.append((y, m))
    metrics["cleared"] = cleared
    return metrics


MONTHS_PROPERTY = "strata.months"


def live_months(spark: SparkSession, name: str) -> dict[int, str]:
    """Which version holds each month (``year * 100 + month``) of a name that ``publish_months`` made."""
    if not spark.catalog.tableExists(name):
        return {}
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {int(k): v for k, v in json.loads(held.get(MONTHS_PROPERTY, "{}")).items()}


def publish_months(
    df: DataFrame,
    name: str,
    root: str,
    ts: str = C.PICKUP.lower(),
    months: Sequence[tuple[int, int]] = (),
    expected_rows: int | None = None,
    rebalance: bool = False,
) -> dict:
    """Replace whole months of ``name`` by one switch.

    The rows are written to a new version folder in the ``year=/month=`` layout,
    counted and their months observed in that write. ``name`` is a view over the
    versions that hold its months, with that list as its property: the months
    written, and those of ``months`` (that the run owns) without rows, leave the
    versions they were in, all others stay where they are. The replaced view is
    the only change, so a reader has all months as before or all as after, and a
    write that fails, or whose row count is not ``expected_rows``, changes nothing.
    """
    spark = df.sparkSession
    key = F.col("year") * 100 + F.col("month")
    staged = stage(with_year_month(df, ts), posixpath.join(root, "versions", name, uuid.uuid4().hex),
                   ("year", "month"), [F.collect_set(key).alias("months")], rebalance)
    rows, written = staged.metrics["rows"], sorted(staged.metrics["months"] or [])
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"{name} stays as it is: {rows} rows were written, {expected_rows} announced")
    before = live_months(spark, name)
    owned = {y * 100 + m for y, m in months}
    after = {k: v for k, v in before.items() if k not in owned} | dict.fromkeys(written, staged.path)
    columns = [f.name for f in staged.schema.fields if f.name not in ("year", "month")] + ["year", "month"]
    selected = []
    for path in sorted(set(after.values())):
        held = {f.name for f in spark.read.parquet(path).schema.fields}
        # a version from before a column was added has none of it
        listed = ", ".join(f"`{c}`" if c in held else f"CAST(NULL AS {staged.schema[c].dataType.simpleString()}) AS `{c}`"
                           for c in columns)
        mine = ", ".join(f"({k // 100}, {k % 100})" for k, v in sorted(after.items()) if v == path)
        selected.append(f"SELECT {listed} FROM parquet.`{path}` WHERE (year, month) IN ({mine})")
    if not selected:
        empty = posixpath.join(staged.path, "empty")
        spark.createDataFrame([], T.StructType([staged.schema[c] for c in columns])).write.parquet(empty)
        selected.append(f"SELECT * FROM parquet.`{empty}`")
    state = json.dumps({str(k): v for k, v in sorted(after.items())})
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{MONTHS_PROPERTY}' = '{state}') AS "
              + " UNION ALL ".join(selected))
    return {"rows": rows, "months": written, "cleared": sorted(k for k in before if k not in after), "path": staged.path}


def expire_versions(spark: SparkSession, folder: str, live: Sequence[str], keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions in a table's folder and the ``live`` ones; returns the deleted.

    A reader that was opened before the last ``keep - 1`` switches finishes, as
    what it reads is still there. Not to be run beside a job that is writing a
    version of the same table.
    """
    versions = storage.folders(spark, folder)  # newest first
    gone = [v for v in versions[max(keep, 1):] if not any(v == p or p.startswith(v + "/") for p in map(storage.plain, live))]
    for path in gone:
        storage.delete(spark, path)
    return gone


def months_between(period_start, period_end) -> list[tuple[int, int]]:
    """The (year, month) pairs that intersect the half-open period."""
    def as_dt(v):
        if isinstance(v, datetime):
            return v
        if isinstance(v, str):
            return datetime.fromisoformat(v)
        return datetime(v.year, v.month, v.day)

    start, end = as_dt(period_start), as_dt(period_end)
    y, m = start.year, start.month
    out = []
    while datetime(y, m, 1) < end:
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out
