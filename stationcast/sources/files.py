"""Folders on any file system that Spark can reach: listing, atomic moves and removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _at(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    files, folder = _at(spark, path)
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; an error if the target is there already."""
    jvm = spark.sparkContext._jvm
    files, folder = _at(spark, source)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(kind, 1)
    none[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(folder),
                   files.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), none)


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _at(spark, path)
    files.delete(folder, True)
