"""Make this package importable in the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors with `addPyFile`, once for an application."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="spark-")) / "corpusmill.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)
    return spark
