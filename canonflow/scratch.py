"""Paths for tables between jobs, in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, a session whose driver and
    executors are one process gets a temporary folder; any other has to name one that all share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", master := spark.conf.get("spark.master", "")):
            raise ValueError(f"spark.checkpoint.dir is unset: with master {master!r} it must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
