"""Python workers get this package from the driver, wherever they run."""

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
    """Adds this package to the files of the application; once for each."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="readloom-")  # the driver alone reads it: Spark serves the file to the workers
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"readloom-{context.applicationId}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, Path(package.name) / f.relative_to(package))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
