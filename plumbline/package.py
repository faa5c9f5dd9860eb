"""This package on the executors: Python workers import what a task's functions refer to."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session's context."""
    context = spark.sparkContext
    if getattr(context, "_plumbline_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="spark-")) / "plumbline.zip"
    with zipfile.ZipFile(target, "w") as package:
        for path in sorted((root / "plumbline").rglob("*.py")):
            package.write(path, path.relative_to(root))
    context.addPyFile(str(target))
    context._plumbline_sent = True
