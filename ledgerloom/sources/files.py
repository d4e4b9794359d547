"""Folders of a table, through the file system that its path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; none if a folder of it is missing."""
    path, system = _opened(spark, pattern)
    return [str(status.getPath()) for status in system.globStatus(path) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is gone."""
    folder, system = _opened(spark, path)
    system.delete(folder, True)


def _opened(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
