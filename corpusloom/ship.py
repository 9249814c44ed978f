"""Send the package to executors that cannot import it from a shared path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add a zip of the package to the application, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom_package.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(p.relative_to(root.parent)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark
