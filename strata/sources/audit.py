"""Run audit: one JSON record per job step, appended to a shared dataset.

Records are tiny driver-side values (ids, times, counts); the dataset is
read back with a fixed schema so an empty or partly written folder never
changes the column types.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pipeline", T.StringType(), False),
        T.StructField("step", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.StringType(), False),
        T.StructField("ended_at", T.StringType(), False),
        T.StructField("duration_seconds", T.DoubleType(), False),
        T.StructField("source_file", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("table_location", T.StringType(), True),
        T.StructField("raw_count", T.LongType(), True),
        T.StructField("silver_count", T.LongType(), True),
        T.StructField("quarantine_count", T.LongType(), True),
        T.StructField("error_type", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)

SUCCESS = "SUCCESS"
FAILED = "FAILED"


def clock() -> datetime:
    """The present moment, in UTC."""
    return datetime.now(tz=timezone.utc)


def record(run_id: str, pipeline: str, step: str, status: str, started_at: datetime,
           ended_at: datetime | None = None, **fields) -> dict:
    """One audit record; unknown field names raise, unset ones are null."""
    known = [f.name for f in AUDIT_SCHEMA.fields]
    if unknown := sorted(set(fields) - set(known)):
        raise KeyError(f"no such audit field: {', '.join(unknown)}")
    end = ended_at or clock()
    values = {name: fields.get(name) for name in known}
    for name in known:
        if name.endswith("_count") and values[name] is not None:
            values[name] = int(values[name])
    return values | {"run_id": run_id, "pipeline": pipeline, "step": step, "status": status,
                     "started_at": started_at.isoformat(), "ended_at": end.isoformat(),
                     "duration_seconds": (end - started_at).total_seconds()}


def append_audit(spark: SparkSession, rec: dict, path: str) -> None:
    """Append one record (one small JSON file) to the audit dataset."""
    row = tuple(rec[f.name] for f in AUDIT_SCHEMA.fields)
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All records; a folder that was never written means no runs yet."""
    try:
        return spark.read.schema(AUDIT_SCHEMA).json(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], AUDIT_SCHEMA)


def table_history(audit: DataFrame) -> DataFrame:
    """Versions of every published table: version number, time, run, counts.

    Numbered per table in publish order; the window is partitioned by table,
    so it never gathers the whole audit into one task.
    """
    published = audit.filter(F.col("table_name").isNotNull() & (F.col("status") == SUCCESS))
    w = Window.partitionBy("table_name").orderBy("ended_at", "run_id")
    return published.select(
        "table_name",
        (F.row_number().over(w) - 1).alias("version"),
        F.col("ended_at").alias("timestamp"),
        F.col("step").alias("operation"),
        "run_id",
        "table_location",
        "raw_count",
        "silver_count",
        "quarantine_count",
    )
