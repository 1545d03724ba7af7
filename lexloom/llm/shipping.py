"""Gives the executors' Python workers this package, wherever the driver has it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once an application: Spark serves the package's sources to every executor, also to later ones."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="lexloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
