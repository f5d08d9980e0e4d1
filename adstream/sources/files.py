"""Small files and folders in whatever store Spark reads: marks, versions, listings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def exists(spark: SparkSession, path: str) -> bool:
    files, at = store(spark, path)
    return files.exists(at)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, in order."""
    files, at = store(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(at) or [])


def changed_ms(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed, in epoch ms."""
    files, at = store(spark, path)
    return files.getFileStatus(at).getModificationTime()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; nothing if it is not there."""
    files, at = store(spark, path)
    files.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """A small file with this text. Without ``replace`` an existing one is an error."""
    files, at = store(spark, path)
    out = files.create(at, replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """All of a small file."""
    files, at = store(spark, path)
    source = files.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
