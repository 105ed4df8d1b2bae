"""The package on the executors, wherever the session was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tradelake

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to all tasks of the application; later calls do nothing."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(tradelake.__file__).parent
    # Spark's file server sends it from the driver to each executor.
    path = Path(tempfile.mkdtemp()) / "tradelake.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, Path("tradelake") / source.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(application)
