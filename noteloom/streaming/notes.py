"""The row-local operators on a stream of notes.

Extraction, lookup, parsing and redaction need no state, so they run on ``readStream`` input as
they are; only the sink needs a checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from noteloom.operators.deidentify import deidentify
from noteloom.operators.extract import extract_patterns
from noteloom.operators.standardise import standardise_patterns

NOTE_SCHEMA = "record_id BIGINT, raw_text STRING"


def stream_notes(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = NOTE_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def standardised_stream(notes: DataFrame) -> DataFrame:
    """The standardised long table of pattern matches."""
    return standardise_patterns(extract_patterns(notes))


def redacted_stream(notes: DataFrame) -> DataFrame:
    """Redacted text and entities without the raw text."""
    return deidentify(notes).select("record_id", "redacted_text", "entities")


def write_stream(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write what is there and stop; run again to go on from the checkpoint."""
    writer = rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
