"""Packing by power-of-two decomposition: sequences of equal binary lengths, none of which crosses documents.

A document of n tokens is cut into whole sequences of the longest length and one piece for every binary digit of
the rest, longest first.  Every piece is a sequence of its own, with no padding, in the bucket of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from noteloom.llm.words import word_encoder

LENGTH = 2048
END = 1
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, part int, place bigint"


def binary_lengths(tokens: int, longest: int = LENGTH) -> list[int]:
    """Lengths of the pieces of a document, in order: 5000 -> 2048, 2048, 512, 256, 128, 8."""
    whole, rest = divmod(tokens, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, vocabulary: str, byte_level: bool = False, longest: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces of every row of ``(doc_id, text)``: ``(doc_id, start, length, ids, doc_tokens, part, place)``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``end`` closes every document.  ``part`` and ``place`` number the
    pieces of a length within a task; write the rows before ``numbered``.  Null and empty texts are one
    piece, the closing id.  Repeated rows and null ids are packed as any other; long texts become as many pieces as
    they need.  Other columns are ignored, and an empty table gives no rows.  ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(vocabulary, byte_level), TaskContext.get().partitionId()
        places: dict[int, int] = {}
        for batch in batches:
            for rows, flat, sizes in encoder.encode(batch.column(1)):
                at, of, start, length, total, data, place = 0, [], [], [], [], [], []
                for i, n in enumerate(sizes.tolist()):
                    own = np.append(flat[at : at + n], np.uint32(end)).astype("<u4")
                    at += n
                    begin = 0
                    for size in binary_lengths(n + 1, longest):
                        of.append(i)
                        start.append(begin)
                        length.append(size)
                        total.append(n + 1)
                        data.append(own[begin : begin + size].tobytes())
                        places[size] = number = places.get(size, -1) + 1
                        place.append(number)
                        begin += size
                ids = batch.column(0).slice(rows.start, rows.stop - rows.start).take(pa.array(of, pa.int64()))
                columns = [ids, *(pa.array(x, pa.int64()) for x in (start, length)), pa.array(data, pa.binary())]
                columns += [pa.array(total, pa.int64()), pa.array([part] * len(of), pa.int32()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "part", "place"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def numbered(rows: DataFrame) -> DataFrame:
    """Written pieces with ``sequence_id``, gapless from 0 over buckets from the longest, and ``offset``, always 0.

    Needs one count for each task and length, never an order over the pieces.
    """
    counts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
    lengths = rows.groupBy("length").agg(F.count("*").alias("n"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each length
    lengths = lengths.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("outer"))
    begin = counts.join(lengths, "length").select("length", "part", (F.col("inner") + F.col("outer")).alias("begin"))
    joined = rows.join(begin, ["length", "part"])
    return joined.withColumn("sequence_id", F.col("begin") + F.col("place")).withColumn("offset", F.lit(0).cast("bigint")).drop("begin", "part", "place")
