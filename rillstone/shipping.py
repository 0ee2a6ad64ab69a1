"""Hands this package to the Python workers of executors that can't import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application, once; Spark serves them to each executor."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="rillstone-")) / "rillstone.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
