"""Dataset inspection and table detail.

Field names and types come from the schema (driver metadata). Row counts are
Spark aggregates. Row-group counts are read from each file's footer by the
executors, one small footer read per file.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.landing import open_uri

FOOTER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("row_groups", T.LongType(), False),
        T.StructField("file_rows", T.LongType(), False),
        T.StructField("optional_fields", T.ArrayType(T.StringType()), False),
    ]
)


def _footer_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for pdf in batches:
        groups, rows, optional = [], [], []
        for uri in pdf["path"]:
            fs, inner = open_uri(uri)
            with fs.open_input_file(inner) as f:
                file = pq.ParquetFile(f)
                meta = file.metadata
                optional.append([x.name for x in file.schema_arrow if x.nullable])
                groups.append(meta.num_row_groups)
                rows.append(meta.num_rows)
        yield pd.DataFrame({"path": pdf["path"], "row_groups": groups, "file_rows": rows,
                            "optional_fields": optional})


def footers(spark: SparkSession, pattern: str) -> DataFrame:
    """Per Parquet file: row groups and rows from its footer (no data pages read)."""
    listing = spark.read.format("binaryFile").load(pattern).select("path")
    listing = listing.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return listing.mapInPandas(_footer_batches, FOOTER_SCHEMA)


def inspect(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per field, each carrying the dataset's rows, columns and row groups.

    The field list is schema metadata; it is attached to the one-row footer
    aggregate with a generator, so no join is needed.
    """
    df = spark.read.parquet(pattern)
    counts = footers(spark, pattern).agg(
        F.sum("file_rows").alias("num_rows"),
        F.sum("row_groups").alias("num_row_groups"),
        F.count(F.lit(1)).alias("num_files"),
        # the distinct lists of optional fields: one, unless files differ
        F.flatten(F.collect_set("optional_fields")).alias("optional"),
    )
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("field_name"),
                 F.lit(f.dataType.simpleString()).alias("field_type"),
                 F.array_contains("optional", F.lit(f.name)).alias("nullable"))
        for i, f in enumerate(df.schema.fields)
    ])
    return counts.select(
        F.inline(fields), "num_rows", "num_row_groups", "num_files",
        F.lit(len(df.columns)).alias("num_columns"),
    )


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    """Format, name, location, file count and bytes of a catalog table.

    Files and sizes come from a listing of the table's folder (the
    ``binaryFile`` source with only ``length`` selected reads no file
    contents), so the cost grows with the number of files, not of rows.
    """
    info = {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    # a published layer is a view over a version folder
    version = re.search(r"FROM parquet\.`([^`]+)`", info.get("View Text") or "")
    location = version[1] if version else info.get("Location")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(location)
        .select("length")
        .agg(F.count(F.lit(1)).alias("numFiles"),
             F.coalesce(F.sum("length"), F.lit(0)).alias("sizeInBytes"))
    )
    return files.select(
        F.lit("parquet" if version else info.get("Provider")).alias("format"),
        F.lit(name).alias("name"),
        F.lit(location).alias("location"),
        "numFiles",
        "sizeInBytes",
    )


def _register_by_value() -> None:
    """Ship this module's task functions by value, so executors need no install."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_register_by_value()
