"""Names in the store that Spark writes to, by Hadoop's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import join_path


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote to this folder has finished."""
    return exists(spark, join_path(path, "_SUCCESS"))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, where = _files(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _files(spark, path)
    fs.delete(where, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already, so of several writers one gets it."""
    fs, where = _files(spark, path)
    fs.mkdirs(where.getParent())
    try:
        return fs.createNewFile(where)
    except Exception as error:  # some stores raise where others return False
        if "AlreadyExists" in str(error):
            return False
        raise
