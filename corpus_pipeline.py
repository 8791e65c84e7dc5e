"""From documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept.  All but the last return
the columns of ``documents``.  ``run`` writes each stage's result as Parquet and reads it again, so a lost
executor costs tasks of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm import line_rules, packing, simhash, toxicity
from noteloom.llm.scratch import ship, written

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model is fitted on what ``labels`` says of them."""
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on words and shared lines, without the lines that too many documents of a host share."""
    return line_rules.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    ship(spark)
    return simhash.deduplicate(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sequences of binary lengths, one row a sequence, with a checksum of its ids."""
    ship(spark)
    cut = packing.pieces(docs, public_tokenizers.path(VOCABULARY))
    return packing.numbered(written(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"))


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

# A fitted classifier, bit counts of hashes and a tokenizer are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
