"""The silver split as a Structured Streaming job.

The split is stateless per row, so the same ``labelled`` plan runs on a
streaming DataFrame unchanged. Each micro-batch is written once, partitioned
by ``_layer/year/month``, into a folder named after its batch id: a batch that
is replayed after a failure overwrites its own folder, so the output is
exactly-once. Progress lives in a checkpoint under the session's shared
checkpoint folder, so the query resumes after a driver or executor loss.
"""

from __future__ import annotations

import posixpath
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions import contract as C
from strata.operators import silver
from strata.sources import publish


def _writer(output: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (
            batch.hint("rebalance", silver.LAYER_COLUMN, "year", "month")
            .write.mode("overwrite")
            .option("compression", publish.COMPRESSION)
            .partitionBy(silver.LAYER_COLUMN, "year", "month")
            .parquet(posixpath.join(output, f"batch={batch_id}"))
        )

    return write_batch


def start_silver_stream(
    bronze_stream: DataFrame,
    output: str,
    checkpoint: str,
    period_start: datetime | date | str,
    period_end: datetime | date | str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the split on a streaming bronze DataFrame."""
    labelled = silver.labelled(bronze_stream, period_start, period_end)
    labelled = publish.with_year_month(labelled, C.PICKUP.lower())
    writer = labelled.writeStream.foreachBatch(_writer(output)).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_layer(spark: SparkSession, output: str, layer: str) -> DataFrame:
    """One layer of the streamed output, over every batch written so far."""
    df = spark.read.option("basePath", output).parquet(
        posixpath.join(output, "batch=*", f"{silver.LAYER_COLUMN}={layer}")
    )
    drop = ["batch", silver.LAYER_COLUMN]
    if layer == silver.SILVER:
        drop.append(C.REASON_COLUMN)
    return df.drop(*[c for c in drop if c in df.columns])


def run_to_completion(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
