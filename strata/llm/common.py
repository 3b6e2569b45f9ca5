"""Shared pieces: table reader, scratch tables, fresh names, word constants."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs of anything but space and the controls 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per application.

    Tasks import them by name, and need not have them installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="strata-package-"), "strata-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)


_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the path may be in any store that Spark reads."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master may run without the setting (tests): it then gets a
    temporary folder. On a cluster an unset folder raises, as a machine-local
    one would lose data with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = "file://" + tempfile.mkdtemp(prefix="strata-llm-")
    return _LOCAL_ROOT


_LOCAL_ROOT: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing else uses it."""
    return f"{scratch_root(spark)}/strata-llm/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new scratch table and read it back.

    The table lives in the shared folder, so a lost executor costs at most a
    task of the next job, never the work that made the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, inside one expression."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def local_path(uri: str) -> str:
    """The plain path of a ``file:`` URI (other URIs are returned unchanged)."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri


def open_fs(uri: str):
    """(filesystem, path) for a folder that tasks write or read by themselves."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), local_path(uri)
    return fs.FileSystem.from_uri(uri)


def text_mark(c: Column) -> Column:
    """Sixteen bytes that tell a row's text from others of the same id; null for a null text."""
    return F.unhex(F.md5(c.cast("binary")))


class WordTable(dict):
    """``value(word)`` for the words of one task, each worked out once while there is room.

    Made by the task that uses it, so nothing of it outlives the task. It starts
    anew when its words and their values fill about ``LIMIT`` bytes, and very
    long words are not kept.
    """

    LIMIT = 24 << 20
    ENTRY = 200  # a slot, a key's and a value's headers
    LONGEST = 256

    def __init__(self, value):
        super().__init__()
        self.value, self.held = value, 0

    def __missing__(self, word):
        found = self.value(word)
        if len(word) <= self.LONGEST:
            self.held += len(word) + self.ENTRY
            if self.held > self.LIMIT:
                self.clear()
                self.held = 0
            self[word] = found
        return found
