"""Trip-shaped input derived from the driver tables.

The driver tables hold no trips, so a trip fact is derived from
``lineitem`` joined with ``orders``: timestamps from the order and ship dates
plus an offset in seconds, NULLs and negative amounts from key arithmetic. The
view reads every row of both tables, so its size grows with the scale factor.
The same view is written as DuckDB SQL so the oracle texts can start from it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The test period of the fixture: pickups in [PERIOD_START, PERIOD_END).
PERIOD_START = "1996-01-01 00:00:00"
PERIOD_END = "2001-01-01 00:00:00"
SOURCE_FILE = "lineitem.parquet"

_TRIPS_SPARK = """
SELECT CAST(l_suppkey AS INT) AS VendorID,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            ELSE timestampadd(SECOND, (l_partkey * 7919) % 86400, o_orderdate) END AS tpep_pickup_datetime,
       CASE WHEN l_partkey % 89 = 0 THEN NULL
            ELSE timestampadd(SECOND, (l_suppkey * 104729) % 86400, l_shipdate) END AS tpep_dropoff_datetime,
       CAST(NULLIF(l_linenumber, 7) AS BIGINT) AS passenger_count,
       CASE WHEN l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS trip_distance,
       CAST(l_partkey % 270 + 1 AS INT) AS PULocationID,
       CAST(l_suppkey % 265 + 1 AS INT) AS DOLocationID,
       CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
       CASE WHEN l_returnflag = 'R' AND l_discount > 0.02
            THEN -l_extendedprice * (1 - l_discount)
            ELSE l_extendedprice * (1 - l_discount) END AS total_amount
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

TRIPS_DUCKDB = """
SELECT CAST(l_suppkey AS INT) AS "VendorID",
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            ELSE o_orderdate + to_seconds((l_partkey * 7919) % 86400) END AS tpep_pickup_datetime,
       CASE WHEN l_partkey % 89 = 0 THEN NULL
            ELSE l_shipdate + to_seconds((l_suppkey * 104729) % 86400) END AS tpep_dropoff_datetime,
       CAST(NULLIF(l_linenumber, 7) AS BIGINT) AS passenger_count,
       CASE WHEN l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS trip_distance,
       CAST(l_partkey % 270 + 1 AS INT) AS "PULocationID",
       CAST(l_suppkey % 265 + 1 AS INT) AS "DOLocationID",
       CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
       CASE WHEN l_returnflag = 'R' AND l_discount > 0.02
            THEN -l_extendedprice * (1 - l_discount)
            ELSE l_extendedprice * (1 - l_discount) END AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# Schemas of the (immutable) driver tables, read once per path: later reads
# skip the footer read of schema inference.
_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trip fact (FIXTURES.md section 3) over the whole tables.

    The fact is rebalanced by the key that the join needs: where both sides are
    shuffled it is the join's own shuffle, and AQE sets the number and the size
    of the partitions. A hash keeps a retried task's rows the same.
    """
    lineitem = table(spark, sf_dir, "lineitem").hint("rebalance", "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    return spark.sql(_TRIPS_SPARK.format(lineitem="{lineitem}", orders="{orders}"),
                     lineitem=lineitem, orders=orders)


def trips_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with both timestamps present (the raw gate passes on it)."""
    t = trips(spark, sf_dir)
    return t.filter(t["tpep_pickup_datetime"].isNotNull() & t["tpep_dropoff_datetime"].isNotNull())


def trips_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The trip fact as a stream: lineitem files arrive, orders is a static side.

    A stream-static inner join needs no state; every lineitem row is joined
    with the order it belongs to as it arrives. ``files_per_batch`` bounds a
    micro-batch; by default one takes all files that are there.
    """
    schema = table(spark, sf_dir, "lineitem").schema
    # a glob that matches the lineitem file(s): the file source watches a folder
    pattern = os.path.join(sf_dir, "lineitem*.parquet")
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lineitem = reader.parquet(pattern)
    orders = table(spark, sf_dir, "orders")
    return spark.sql(_TRIPS_SPARK.format(lineitem="{lineitem}", orders="{orders}"),
                     lineitem=lineitem, orders=orders)
