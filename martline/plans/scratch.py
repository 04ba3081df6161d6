"""Folders for the tables a query writes before it reads them back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder under the shared directory the session names, or under a local one where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not shared:
        shared = tempfile.mkdtemp(prefix="martline-")
    return f"{shared.rstrip('/')}/martline-{uuid.uuid4().hex}"
