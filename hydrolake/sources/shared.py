"""Folders that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; where that is unset, a local master (tests) gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
