"""Folders that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset a local one, for a local master alone.

    On a cluster each executor would write to its own disk, so there the setting must be made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


_made: list[tuple[SparkSession, str]] = []


def work_folder(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark)}/membertide-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def _delete_made() -> None:
    for spark, path in _made:
        context = spark.sparkContext
        if context._jsc is not None and not context._jsc.sc().isStopped():
            delete_folder(spark, path)


atexit.register(_delete_made)
