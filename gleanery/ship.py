"""Bring this package to the executors, whatever folder the driver was started in."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def packages(spark: SparkSession) -> None:
    """Add the sources of the package to the session once. Spark's own file server hands them out, so no shared folder is needed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "gleanery.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "gleanery")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
