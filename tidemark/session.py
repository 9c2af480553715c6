"""Folders a job may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str | None:
    """The folder the cluster names in ``spark.checkpoint.dir``, or else the one set on the context."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one.  Every executor must be able to reach it."""
    root = shared_root(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def with_local_scratch(spark: SparkSession) -> SparkSession:
    """For entry points: gives a session on one machine a scratch folder where none is set.

    On a cluster nothing is set, so that work which needs a shared folder fails loudly.
    """
    master = spark.sparkContext.master
    if (master == "local" or master.startswith("local[")) and not shared_root(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scratch-"))
    return spark
