"""The package on the executors of a cluster that does not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="framespan-"), "framespan.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(folder):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.join("framespan", os.path.relpath(path, folder)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
