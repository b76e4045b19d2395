"""Existence tests, markers and deletes on the file system of a path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; nothing happens if ``target`` is there already."""
    fs, p = _fs(spark, target)
    if not fs.exists(p):
        fs.mkdirs(p.getParent())
        fs.rename(_fs(spark, source)[1], p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (none if it is not there)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if written(spark, path) else None
