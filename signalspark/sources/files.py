"""Small helpers over the file system that a path names (shared storage on a cluster)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def put(spark: SparkSession, path: str) -> None:
    """An empty file, created whole."""
    fs, where = _at(spark, path)
    fs.create(where, True).close()


def rename(spark: SparkSession, path: str, to: str) -> bool:
    fs, where = _at(spark, path)
    return fs.rename(where, _at(spark, to)[1])


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds since 1970 of a file's last change."""
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).getModificationTime()


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
