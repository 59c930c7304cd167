"""Makes this package importable on executors that were started without it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp()  # the driver serves the file for as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
