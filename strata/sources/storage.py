"""Where jobs write, and the few file-system operations they need.

The root is the shared folder the cluster names in ``spark.checkpoint.dir``
(read from the session). Only when it is unset, as in local tests, a folder
is created for it. File operations go through the Hadoop ``FileSystem`` of the
path, so they work on HDFS and object stores as well as local disk.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

_WORK_SUBDIR = "strata"


def checkpoint_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` itself, the same for every application of a cluster.

    A local master may run without the setting (tests) and then gets a temporary
    folder; on a cluster that would be one machine's, so it raises there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file:" + tempfile.mkdtemp(prefix="strata-work-"))
    return _LOCAL[0]


_LOCAL: list[str] = []


def work_root(spark: SparkSession) -> str:
    """The library's folder under the shared root; jobs of later applications find it."""
    return posixpath.join(checkpoint_root(spark), _WORK_SUBDIR)


def new_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-used folder under the work root (one per run or version)."""
    return posixpath.join(work_root(spark), *parts, uuid.uuid4().hex)


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; False when it did not exist."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def plain(path: str) -> str:
    """A path without the scheme of the local file system."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in a folder, the last changed first; none where it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getModificationTime(), plain(s.getPath().toString())) for s in fs.listStatus(p) if s.isDirectory()]
    return [name for _, name in sorted(found, reverse=True)]
