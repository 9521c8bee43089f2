"""Makes this package importable on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's Python files, once a context
    (Spark's own file server hands them to executors, also to later ones)."""
    sc = spark.sparkContext
    if getattr(sc, "_portrait_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="portrait-py-"), "portrait_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith((".py", ".txt")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._portrait_shipped = True
