"""Written intermediate tables, in the folder that all executors share."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  A local one is made only where that is unset and all work is local, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set, and a folder of this machine is not seen by the others")
        folder = f"file://{tempfile.mkdtemp(prefix='noteloom-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path that nothing has used before."""
    return f"{shared_dir(spark)}/noteloom-{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once as Parquet and read back: a cut lineage that lost executors can't take away."""
    spark = rows.sparkSession
    path = fresh(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def unused(rows: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def opened_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI as Spark writes it, and the path in it, for tasks that read and write files themselves."""
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started from."""
    if getattr(spark.sparkContext, "_noteloom_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="noteloom-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/noteloom", "zip", PACKAGE.parent, PACKAGE.name))
    spark.sparkContext._noteloom_shipped = True
