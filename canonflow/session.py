"""Session settings that the engine's results rest on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """UTC, so texts of instants don't shift; ANSI, so bad numbers raise; AQE."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends the package to the session's Python workers, once for each application, so that they
    find it however they were started. Only operators with Python inside tasks need it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
