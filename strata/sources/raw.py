"""Scans: raw files, catalog tables, the partitioned silver layout, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_missing_path(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", lambda: None)() or ""
    return "PATH_NOT_FOUND" in cond or "Path does not exist" in str(err)


def read_raw(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of the raw file(s); optionally only the listed columns.

    Selecting columns lets Catalyst prune the scan (``ReadSchema``). A
    missing path raises ``FileNotFoundError`` so jobs can audit the failure.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as err:
        if _is_missing_path(err):
            raise FileNotFoundError(f"raw file not found: {path}") from err
        raise
    return df.select(*columns) if columns else df


def read_partitioned(
    spark: SparkSession,
    root: str,
    years: Sequence[int] | None = None,
    months: Sequence[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The ``year=*/month=*`` layout under ``root`` with partition columns.

    Filters on ``year``/``month`` are partition filters: files of other folders
    are not read. With ``schema`` (partition columns included) no file is opened
    to plan the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root)
    if years is not None:
        df = df.filter(F.col("year").isin(list(years)))
    if months is not None:
        df = df.filter(F.col("month").isin(list(months)))
    return df


def row_count(spark: SparkSession, path: str, required: bool = True,
              schema: T.StructType | None = None) -> int:
    """Rows of a dataset; a missing optional dataset counts as zero.

    A Parquet ``count()`` reads no columns (empty ``ReadSchema``).
    """
    from strata.sources import storage

    if not storage.exists(spark, path):
        if required:
            raise FileNotFoundError(f"dataset not found: {path}")
        return 0
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path).count()
    except AnalysisException as err:
        if not _is_missing_path(err) and "UNABLE_TO_INFER_SCHEMA" not in str(err):
            raise
        if required:
            raise FileNotFoundError(f"dataset not found: {path}") from err
        return 0
