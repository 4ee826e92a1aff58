"""Makes this package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        folder = os.path.realpath(tempfile.mkdtemp())  # the driver serves the file from here until it ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, "stagelight_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
