"""The package on the executors' Python path."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package's code to the executors, once for each application.

    Spark serves the archive from the driver; executors that start later, or
    replace lost ones, get it too.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        code = io.BytesIO()
        with zipfile.ZipFile(code, "w") as archive:
            for module in sorted(package.rglob("*.py")):
                archive.write(module, module.relative_to(package.parent))
        path = Path(tempfile.mkdtemp()) / "lakestrata.zip"
        path.write_bytes(code.getvalue())
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return spark
