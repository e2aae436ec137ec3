"""Makes this package importable in the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import shelfspan

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(shelfspan.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfspan-"), "shelfspan.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
