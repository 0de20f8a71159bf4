"""Sends the package's code to the session's Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ARCHIVE = "tideline-code.zip"


def ship(spark: SparkSession) -> None:
    """Makes `tideline` importable in Python workers that have not got it installed.
    The archive goes out through Spark; once a session."""
    context = spark.sparkContext
    if ARCHIVE in context._python_includes:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / ARCHIVE
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(archive))
