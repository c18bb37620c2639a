"""Where jobs put tables that outlive one plan."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, named by the cluster in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-"))
    return context.getCheckpointDir().rstrip("/")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that the session reads; none if there is no such folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(at)] if files.exists(at) else []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"
