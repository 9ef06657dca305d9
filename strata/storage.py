"""Files and folders through Hadoop's file system, whatever store a path names.

Only metadata passes through the driver here: listings of one folder, renames
and deletions. Data moves in tasks.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern fits, in order."""
    p, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly in a folder (or the file itself), without markers and checksums."""
    p, fs = _path(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    return sorted(f.toString() for f in found if not f.getName().startswith(("_", ".")))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target's parent is made, the target must not exist."""
    p, fs = _path(spark, source)
    q = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_small(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file that appears whole or not at all: written aside, then renamed."""
    p, fs = _path(spark, f"{folder}/.{name}")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{folder}/.{name}", f"{folder}/{name}")


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the actions inside are deleted when each one ends, not
    when the driver next collects garbage. For frames that run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
