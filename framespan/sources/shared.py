"""The folder that all machines of the cluster share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new place below spark.checkpoint.dir, or below the checkpoint folder set on the context."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not found.isDefined():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = found.get()
    return f"{root}/{name}-{uuid.uuid4().hex}"
