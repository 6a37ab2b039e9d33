"""The package for the Python workers of the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to all workers, once per application; Spark serves and fetches the file."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, path = tempfile.mkstemp(prefix="tallyflow-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
