"""Reading and writing notes and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.sources.annotations import parse_annotations
from noteloom.sources.schemas import RECORD, SOURCE


def read_source(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Annotated source rows from Parquet, CSV or JSON, with a declared schema.

    Parquet keeps its own column types; ``id`` is cast later.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": "true", "multiLine": "true", "escape": '"', **options}
    if fmt != "parquet":
        reader = reader.schema(SOURCE)
    rows = reader.options(**options).load(path)
    return rows.select("id", "sentence", "icd_label", "annonymisation", "disease")


def shape_records(rows: DataFrame) -> DataFrame:
    """Nested records from source rows with parsed annotations."""
    return rows.select(
        F.col("id").cast("bigint").alias("record_id"),
        F.col("sentence").alias("raw_text"),
        F.struct(
            F.col("icd_label").alias("icd_labels"),
            F.col("annonymisation").alias("anon_spans"),
            F.col("disease").alias("disease_spans"),
        ).alias("ground_truth"),
    )


def read_notes(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Source rows, parsed and shaped."""
    return shape_records(parse_annotations(read_source(spark, path, fmt, **options)))


def read_records(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """Records written by :func:`write_records`, or one JSON array of records with ``multi_line``.

    A JSON array file cannot be split, so it is for exchange only; keep large data in Parquet.
    """
    if fmt == "json":
        return spark.read.schema(RECORD).option("multiLine", multi_line).json(path)
    return spark.read.format(fmt).load(path)


def write_records(records: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    records.write.mode(mode).format(fmt).save(path)


def label_arrays(records: DataFrame) -> DataFrame:
    """``(record_id, raw_text, icd_labels, disease_spans, anon_spans)`` with the span texts as arrays."""
    return records.select(
        "record_id",
        "raw_text",
        F.col("ground_truth.icd_labels").alias("icd_labels"),
        F.col("ground_truth.disease_spans.entity").alias("disease_spans"),
        F.col("ground_truth.anon_spans.entity").alias("anon_spans"),
    )


def disease_spans(records: DataFrame) -> DataFrame:
    """Long table ``(record_id, ord, entity)`` of the annotated diagnoses."""
    long = records.select(
        "record_id", F.posexplode(F.col("ground_truth.disease_spans.entity")).alias("ord", "entity")
    )
    return long
