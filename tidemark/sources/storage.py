"""File operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False when somebody else has made it."""
    fs, p = _path(spark, path)
    return fs.createNewFile(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing when there is no such folder."""
    fs, p = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


def modified_millis(spark: SparkSession, path: str) -> int | None:
    """When a file was last written, or None when it is gone."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None
