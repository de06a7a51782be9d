"""Making this package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to every executor, once per application.

    The archive is written on the driver only and handed to Spark's own file
    server, so executors that join later get it too.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    fd, name = tempfile.mkstemp(prefix=f"{root.name}_", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)
