"""What a job needs from its session."""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def get_or_create_spark(app_name: str = "daily-series-forecasting") -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, however the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    parent = os.path.dirname(_PACKAGE)
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for folder, _, files in os.walk(_PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor sees, as the cluster names it; None if it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder for checkpoints; only a local session may fall back to its own disk."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = shared_folder(spark)
    if folder is None and context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if folder is not None:
        context.setCheckpointDir(folder)
