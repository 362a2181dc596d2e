"""Folders that change as a whole: versions, each committed by an empty file.

A writer fills ``<path>/version-<n>-<id>`` and then creates the empty file
``<path>/committed-<n>-<id>``.  Creating an empty file is one step on every
Hadoop file system, so readers, who take the greatest committed version, see
the old state or the new one and never a part.  A writer that dies leaves a
version that nobody reads.  Of two writers at once, both commit and the
greater id is read.  Versions before the last two are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

VERSION, COMMITTED = "version-", "committed-"
KEPT = 2    # the committed version and the one before, which readers may still hold


def _open(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Committed versions ``<n>-<id>``, oldest first."""
    fs, root = _open(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n.removeprefix(COMMITTED) for n in names if n.startswith(COMMITTED))


def new_version(spark: SparkSession, path: str) -> str:
    """The (not yet existing) folder of a next version, to be filled."""
    done = _committed(spark, path)
    number = int(done[-1].split("-")[0]) + 1 if done else 1
    return f"{path.rstrip('/')}/{VERSION}{number:012d}-{uuid.uuid4().hex}"


def commit_version(spark: SparkSession, folder: str) -> None:
    """Make a filled version the one that readers take."""
    path, name = folder.rsplit("/", 1)
    fs, marker = _open(spark, f"{path}/{COMMITTED}{name.removeprefix(VERSION)}")
    if not fs.createNewFile(marker):
        raise RuntimeError(f"{folder} is committed already")
    for old in _committed(spark, path)[:-KEPT]:
        fs.delete(_open(spark, f"{path}/{COMMITTED}{old}")[1], False)     # first: no reader finds it any more
        fs.delete(_open(spark, f"{path}/{VERSION}{old}")[1], True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the greatest committed version; ``None`` if there is none."""
    done = _committed(spark, path)
    return f"{path.rstrip('/')}/{VERSION}{done[-1]}" if done else None
