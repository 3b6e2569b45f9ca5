"""Landing-zone checks over many files, distributed over the executors.

The listing comes from the ``binaryFile`` source with only ``path`` and
``length`` selected, so file contents are never loaded. The Parquet magic
bytes (``PAR1`` at both ends) are then read by the executors, 8 bytes per
file, in a ``mapInPandas`` over the listing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the Parquet file signature at the start and end of every file.
PARQUET_MAGIC = b"PAR1"
MIN_PARQUET_BYTES = 8

INTEGRITY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("has_magic", T.BooleanType(), False),
    ]
)


# Schemes that the file library opens, with the names it knows them by.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def open_uri(uri: str):
    """(file system, path) of a file; a scheme that cannot be opened raises ``ValueError``."""
    import pyarrow.fs as pafs

    scheme, _, rest = uri.partition(":")
    if scheme not in _SCHEMES:
        raise ValueError(f"cannot open {uri}: scheme {scheme} is not one of {', '.join(_SCHEMES)}")
    return pafs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:///{rest.lstrip('/')}" if scheme == "file"
                                    else f"{_SCHEMES[scheme]}:{rest}")


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, length`` of every file matching the glob (no content read)."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length")


def _magic_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        flags = []
        for path, length in zip(pdf["path"], pdf["length"]):
            ok = False
            if length >= MIN_PARQUET_BYTES:
                # an unreadable file raises: only its bytes may say that it is not Parquet
                fs, inner = open_uri(path)
                with fs.open_input_file(inner) as f:
                    ok = f.read_at(4, 0) == PARQUET_MAGIC and f.read_at(4, length - 4) == PARQUET_MAGIC
            flags.append(ok)
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"].astype("int64"),
                            "has_magic": flags})


def check_landing(listing: DataFrame) -> DataFrame:
    """Per file: length, magic bytes, and ``valid`` (both ends are ``PAR1``).

    The listing is dealt out by count: its own splits go by file length, about a
    task for every file, although eight bytes of each are read.
    """
    tasks = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checked = listing.repartition(tasks).mapInPandas(_magic_batches, INTEGRITY_SCHEMA)
    return checked.withColumn(
        "valid", (F.col("length") >= MIN_PARQUET_BYTES) & F.col("has_magic")
    )


def check_lengths(checked: DataFrame, manifest: DataFrame) -> DataFrame:
    """Compare received length with the announced one (``path, announced_length``).

    Files with no announced length pass this check; a file is accepted only
    when it is valid Parquet and its length matches when announced.
    """
    joined = checked.join(manifest, "path", "left")
    length_ok = F.col("announced_length").isNull() | (
        F.col("announced_length") == F.col("length")
    )
    return joined.withColumn("length_ok", length_ok).withColumn(
        "accepted", F.col("valid") & F.col("length_ok")
    )


def new_files(checked: DataFrame, landed: DataFrame) -> DataFrame:
    """Valid files not landed before: a file already landed is not taken again."""
    return checked.filter(F.col("valid")).join(landed.select("path"), "path", "left_anti")


def _register_by_value() -> None:
    """Ship this module's task functions by value, so executors need no install."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_register_by_value()
