"""Small helpers over the Hadoop file system, for any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty where it is missing."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, target = _fs(spark, path)
    fs.create(target, True).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")
