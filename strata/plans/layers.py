"""The medallion layers of the fixture as lazily composed DataFrames.

These are plans, not materialised tables: Catalyst prunes every layer to the
columns a query needs and pushes its filters into the scans. Jobs in
``strata.plans.jobs`` write the same layers out when they must be published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import marts, silver
from strata.plans import fixtures


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.add_lineage(fixtures.trips(spark, sf_dir), fixtures.SOURCE_FILE)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return silver.split(bronze(spark, sf_dir), fixtures.PERIOD_START, fixtures.PERIOD_END)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_rows(bronze(spark, sf_dir), fixtures.PERIOD_START, fixtures.PERIOD_END)


def quarantine_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quarantine_rows(bronze(spark, sf_dir), fixtures.PERIOD_START,
                                  fixtures.PERIOD_END)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stage(silver_trips(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.enrich(staged(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_mart(enriched(spark, sf_dir))


def daily_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart written as a published version and read back.

    For checks that read the daily mart several times (monthly, quality and
    their rules): the fact table is aggregated once, by the publish.
    """
    from strata.sources import publish, storage

    staged = publish.stage(daily(spark, sf_dir), storage.new_dir(spark, "published", "daily"))
    return spark.read.schema(staged.schema).parquet(staged.path)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_mart(daily(spark, sf_dir))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.quality_mart(daily(spark, sf_dir))
