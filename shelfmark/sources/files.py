"""Folders of any file system Spark reaches, seen from the driver: listings and deletions, never contents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    """A path of the session's Hadoop libraries and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, system = _path(spark, folder)
    return system.exists(path)


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders with all they hold; missing ones are no error."""
    for folder in folders:
        path, system = _path(spark, folder)
        system.delete(path, True)


def empty_files(spark: SparkSession, folders: str | Iterable[str], glob: str) -> list[str]:
    """Files of no bytes, which Spark's file sources pass over.  Folders may be patterns."""
    found = []
    for folder in [folders] if isinstance(folders, str) else folders:
        path, system = _path(spark, f"{folder.rstrip('/')}/{glob}")
        for status in system.globStatus(path) or []:
            if status.isFile() and status.getLen() == 0:
                found.append(status.getPath().toUri().toString())
    return found
