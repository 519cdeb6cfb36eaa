"""File-system questions answered by Spark's own file systems (local, HDFS, object stores)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder without hidden ones; empty if the folder is missing. Other failures raise."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in names if n[0] not in "._")


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return bool(fs.exists(where))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds."""
    fs, where = _open(spark, path)
    fs.delete(where, True)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Size, file count and change time of a file or folder tree."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return "missing"
    total = fs.getContentSummary(where)
    files = fs.listStatus(where)
    changed = max([s.getModificationTime() for s in files], default=0)
    return f"{total.getLength()}-{total.getFileCount()}-{changed}"


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole, or leave the one that is there and return False; of several callers one succeeds.

    The file appears under its name when its content is complete: by a hard link on
    local or mounted disks, elsewhere by a rename, which HDFS refuses if the name is taken.
    """
    fs, where = _open(spark, path)
    hidden = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    aside = _open(spark, hidden)[1]
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(aside.toUri().getPath(), where.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return not fs.exists(where) and bool(fs.rename(aside, where))
    finally:
        fs.delete(aside, False)
