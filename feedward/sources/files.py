"""Listing, marking and deleting paths in any storage that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted. Lists directories only; starts no job."""
    fs, jpath = _file_system(spark, pattern)
    found = fs.globStatus(jpath)
    return sorted(status.getPath().toString() for status in found or [])


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path and all below it, if it is there."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file at the path."""
    fs, jpath = _file_system(spark, path)
    fs.create(jpath, True).close()
