"""Makes this package importable in the executors' Python, like ``spark-submit --py-files``."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source files to Spark once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = __name__.partition(".")[0]
    # the driver serves the archive from here for as long as the application runs
    folder = tempfile.TemporaryDirectory(prefix=f"{name}-py-")
    atexit.register(folder.cleanup)
    archive = os.path.join(folder.name, f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, files in os.walk(os.path.join(root, name)):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(at, f)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
