"""Folders for tables that a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder that nothing has used before, below ``spark.checkpoint.dir``, which all executors see.

    A local one is made only where that is unset and all work is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set, and a folder of this machine is not seen by the others")
        folder = f"file://{tempfile.mkdtemp(prefix='noteloom-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/noteloom-{name}-{uuid.uuid4().hex}"
