"""File-system questions answered through Hadoop, so they hold on any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where)


def is_file(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isFile()


def child_names(spark: SparkSession, path: str) -> list[str]:
    where, fs = _at(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []


def bytes_below(spark: SparkSession, path: str) -> int:
    """Length of a file, or of all files below a folder; 0 where there is nothing."""
    where, fs = _at(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, with all it holds."""
    where, fs = _at(spark, path)
    fs.delete(where, True)
