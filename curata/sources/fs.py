"""Small file-system helpers through Hadoop's FileSystem API.

They work on any path the cluster can reach (HDFS, object stores, local),
because they go through the session's Hadoop configuration rather than the
driver's local disk.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all below it; nothing happens if it isn't there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory()]
