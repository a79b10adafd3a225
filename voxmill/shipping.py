"""Ships the package to Python workers, so that a session need not have it on its executors' path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package as a zip file to the session's workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="voxmill-code-")) / "voxmill.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return spark
