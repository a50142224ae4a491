"""Sends this library to executors that do not have it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as an archive (once a Spark application), unless Python workers find it on their path anyway."""
    sc = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _sent:
        return
    folder = tempfile.mkdtemp()  # the driver's own; Spark serves the file to executors
    sc.addPyFile(shutil.make_archive(f"{folder}/syncforge", "zip", ROOT, "syncforge"))
    _sent.add(sc.applicationId)
