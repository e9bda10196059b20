"""What already lies at a path."""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession


def _status(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Asks the path's own file system, not the driver's disk."""
    file_system, hadoop_path = _status(spark, path)
    return file_system.exists(hadoop_path)


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path was completed: it ends with its marker, whoever committed it."""
    return exists(spark, posixpath.join(path, "_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of this library."""
    file_system, hadoop_path = _status(spark, path)
    file_system.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file_system, hadoop_path = _status(spark, path)
    stream = file_system.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    file_system, hadoop_path = _status(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, by: str) -> None:
    """Put a finished output in the place of another; cut off in between, neither is there and it is made again."""
    file_system, hadoop_path = _status(spark, path)
    file_system.delete(hadoop_path, True)
    if not file_system.rename(_status(spark, by)[1], hadoop_path):
        raise OSError(f"cannot move {by} to {path}")
