"""Small files on the session's file systems: listing, deleting, publishing by a
rename, and claiming a name exactly once."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where there is no folder."""
    p, fs = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> int | None:
    """Milliseconds since 1970 of a file's last change; None where there is none."""
    p, fs = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the folder of ``target`` is made where it is missing."""
    (a, fs), (b, _) = _open(spark, source), _open(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` beside ``path``, then rename it there: a reader sees the
    whole file or none."""
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    p, fs = _open(spark, staged)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    move(spark, staged, path)


def claim(spark: SparkSession, path: str) -> bool:
    """Create the empty file ``path``; False if it is there already. Of several
    callers exactly one gets True, on local and HDFS-like file systems (an object
    store needs a conditional put behind ``create`` without overwriting)."""
    p, fs = _open(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":  # the only call that checks and creates at once there
        return spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile()
    try:
        fs.create(p, False).close()
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    return True
