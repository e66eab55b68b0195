"""Gives the executors this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import reviewmart

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(reviewmart.__file__).parent
    if root.is_dir():
        archive = os.path.join(tempfile.mkdtemp(prefix="reviewmart-"), "reviewmart.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
