"""Stage tables that a broken run can go on from, and that joins by record need not move.

Every stage is a table below one folder, with a mark beside it: a fingerprint of the stage's options and of the marks of the
tables it was made from, down to names, sizes and times of the source files.  A mark is taken away before its table is
written and put back after, so a table with the right mark is whole and up to date.

With ``buckets``, Parquet tables with a ``record_id`` are bucketed and sorted by it.  The first one is dealt out once; those
made from it row by row keep the order, and joins of them move no texts.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.sources.notes import read_records, write_records

KEY = "record_id"


def table_digest(table: DataFrame) -> str:
    """A fingerprint of the rows of a table in any order: their number and the sums of two hashes."""
    rows = [F.xxhash64(F.lit(seed), *table.columns).cast("decimal(38,0)") for seed in (1, 2)]
    return ":".join(map(str, table.agg(F.count("*"), *[F.coalesce(F.sum(r), F.lit(0)) for r in rows]).first()))


def source_mark(spark: SparkSession, path: str) -> str:
    """A fingerprint of names, sizes and times of the files below a path; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return table_digest(files.select("path", "length", "modificationTime"))


class Stages:
    """The stage tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "parquet", buckets: int | None = None):
        self.spark, self.folder, self.fmt, self.buckets = spark, folder.rstrip("/"), fmt, buckets

    def path(self, stage: str) -> str:
        return f"{self.folder}/{stage}"

    def _name(self, stage: str) -> str:
        return f"noteloom_{hashlib.md5(self.path(stage).encode()).hexdigest()}"

    def mark(self, stage: str) -> str | None:
        """The mark of a stage; None if the stage has not been finished."""
        try:
            row = self.spark.read.schema("value string").text(self.path(f"_marks/{stage}")).first()
        except AnalysisException:
            return None
        return row[0] if row and row[0] else None

    def _set_mark(self, stage: str, mark: str) -> None:
        self.spark.range(1).select(F.lit(mark).alias("value")).coalesce(1).write.mode("overwrite").text(self.path(f"_marks/{stage}"))

    def wanted_mark(self, stage: str, inputs: tuple[str, ...], options: str) -> str:
        marks = [self.mark(i) or "unfinished" for i in inputs]
        return hashlib.sha256("\n".join([stage, self.fmt, str(self.buckets), options, *marks]).encode()).hexdigest()

    def _bucketed(self, columns: list[str]) -> bool:
        return bool(self.buckets) and self.fmt == "parquet" and KEY in columns

    def save(self, table: DataFrame, stage: str, inputs: tuple[str, ...] = (), options: str = "", resume: bool = False, deal: bool = False) -> DataFrame:
        """Write a stage and read it back; with ``resume``, a stage whose mark is the wanted one is only read.

        ``deal`` sends the rows to their buckets first, for a table that was not made from a bucketed one.
        """
        mark = self.wanted_mark(stage, inputs, options)
        if resume and self.mark(stage) == mark:
            return self.load(stage)
        self._set_mark(stage, "")
        if self._bucketed(table.columns):
            rows = table.repartition(self.buckets, KEY) if deal else table
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(stage)}")
            write = rows.write.format("parquet").mode("overwrite").option("path", self.path(stage))
            write.bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(self._name(stage))
        else:
            write_records(table, self.path(stage), self.fmt)
        self._set_mark(stage, mark)
        return self.load(stage)

    def load(self, stage: str) -> DataFrame:
        """A stage as it was written; a session that did not write a bucketed one makes its table known first."""
        if not self.buckets or self.fmt != "parquet":
            return read_records(self.spark, self.path(stage), self.fmt)
        rows = self.spark.read.parquet(self.path(stage))
        if not self._bucketed(rows.columns):
            return rows
        if not self.spark.catalog.tableExists(self._name(stage)):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            layout = f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {self._name(stage)} ({fields}) USING parquet {layout} LOCATION '{self.path(stage)}'")
        return self.spark.table(self._name(stage))
