"""Folders on whatever file system the cluster uses, through Hadoop's own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder made by this library; a missing one is fine."""
    system, target = _at(spark, path)
    return system.delete(target, True) if system.exists(target) else False


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders: names only, no data is read."""
    system, target = _at(spark, path)
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target) if status.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(column + "="))


def written(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to the folder has been committed."""
    return exists(spark, path + "/_SUCCESS")
