"""Sending this package to Python workers that do not have it."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Give the package to all workers of the session's cluster, once. Spark serves the archive from the driver."""
    context = spark.sparkContext
    if getattr(context, "_has_duplexa", False):
        return
    root = Path(__file__).resolve().parent
    files = sorted(p for p in root.rglob("*.py"))
    mark = hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()[:16]
    folder = tempfile.mkdtemp(prefix="duplexa-")
    archive = os.path.join(folder, f"duplexa-{mark}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for p in files:
            out.write(p, str(Path(root.name) / p.relative_to(root)))
    context.addPyFile(archive)
    context._has_duplexa = True
