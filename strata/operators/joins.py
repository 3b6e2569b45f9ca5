"""Zone dimension and the fact-to-dimension left join.

``auto`` leaves the choice to Spark, which broadcasts a side only below its own
byte threshold. ``broadcast`` is for a dimension with a row bound that is
checked first and raises beyond it. ``merge`` spreads every key over ``salt``
parts of the fact by a hash of the row (and repeats the dimension's rows as
often), so a key space of a few hundred equally heavy zones still fills a large
cluster, and a map task that is run again sends every row where it went before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import contract as C

# Upper bound on dimension rows we are willing to broadcast.
MAX_BROADCAST_ROWS = 100_000
SALT = 16


def zone_dim(spark: SparkSession, n: int = C.ZONE_COUNT) -> DataFrame:
    """Zone ids 1..n with a ``zone_<id>`` label."""
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("location_id"),
        F.concat(F.lit(C.ZONE_LABEL_PREFIX), F.col("id")).alias("zone_label"),
    )


def trips_for_join(trips: DataFrame, period_start: str, period_end: str) -> DataFrame:
    """Pickup zone and amount of the trips in the period (renamed for the join)."""
    p = F.col(C.PICKUP)
    return trips.filter((p >= F.lit(period_start)) & (p < F.lit(period_end))).select(
        F.col(C.PU_LOCATION).alias("pickup_location_id"), F.col(C.TOTAL)
    )


def zone_join(
    fact: DataFrame,
    dim: DataFrame,
    strategy: str = "auto",
    fact_key: str = "pickup_location_id",
    dim_key: str = "location_id",
    max_rows: int = MAX_BROADCAST_ROWS,
    salt: int = SALT,
) -> DataFrame:
    """Left outer join of the fact to the dimension by the strategy asked for.

    ``broadcast`` counts the dimension and raises ``ValueError`` when it has
    more than ``max_rows`` rows; it never turns into another join.
    """
    if strategy == "auto":
        return fact.join(dim, fact[fact_key] == dim[dim_key], "left")
    if strategy == "broadcast":
        rows = dim.count()
        if rows > max_rows:
            raise ValueError(f"dimension of {rows} rows is above the broadcast bound of {max_rows}")
        return fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key], "left")
    if strategy == "merge":
        # by the row's values, so that a task that runs again deals its rows the same way
        left = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salt)))
        right = dim.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
        met = left.hint("merge").join(
            right.hint("merge"), (left[fact_key] == right[dim_key]) & (left["_salt"] == right["_part"]), "left")
        return met.drop("_salt", "_part")
    raise ValueError(f"unknown join strategy: {strategy}")
