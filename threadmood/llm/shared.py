"""Helpers of this package: intermediate tables in the folder that all executors share, and bindings in expressions."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _test_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder the session names; only a local session may go without that setting."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        folder = _test_folder(context.applicationId)
    return posixpath.join(folder, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once: cuts the lineage, and a lost executor costs nothing that was done."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that is not broadcast at any size.

    Spark takes a stored table for as large as its files. Numbers are several times as large in
    memory, so what is under the limit as a file can still fill the driver.
    """
    return df.hint("merge")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where the body's own lambdas use it per element."""
    return F.transform(F.array(value), body)[0]


def parts_of(df: DataFrame) -> int:
    """Partitions the input is read in, a measure of its size that the plan knows without a job."""
    return max(1, df.rdd.getNumPartitions())
