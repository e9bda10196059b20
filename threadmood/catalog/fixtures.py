"""Where the catalog's queries put the files they read back."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of the machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"threadmood-{application}-")


def working_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    return posixpath.join(shared_folder(spark), "threadmood", run, name)


def cores(spark: SparkSession) -> int:
    """Partitions the catalog deals its comments over: the given tables come as one split each."""
    return spark.sparkContext.defaultParallelism
