"""Folders and markers, through the file system that Spark itself uses.

Everything here is a name or an empty file: no data passes the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, hidden names included; none where the folder is missing."""
    fs, place = _at(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(place) or [])


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file as a marker."""
    fs, place = _at(spark, path)
    fs.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or marker; one that is gone already is no error."""
    fs, place = _at(spark, path)
    fs.delete(place, True)
