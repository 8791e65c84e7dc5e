"""A dictionary of matched terms that is kept between runs.

Matching is costly by distinct term, and most terms of a run were in the one before.  Matched terms are written below a folder
whose name is a fingerprint of all that a match depends on: vocabulary, diagnoses, thresholds and switches.  A run matches only
terms that its folder does not have and adds them; if anything it depends on changes, the name does, and nothing old is used.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.functions import similarity as sim
from noteloom.functions.vocabulary import DIAGNOSES, abbreviations_df
from noteloom.operators.matching import entries
from noteloom.operators.standardise import cascade, match_terms, one_per_term
from noteloom.sources.stages import table_digest

MATCHES = "term string, standard string, score double, method string"
# Changed when the way of matching is, so that no result of an earlier one is used.
RULES = "2"


def fingerprint(
    spark: SparkSession,
    vocabulary: DataFrame | None = None,
    diagnoses: list[str] | DataFrame | None = None,
    fuzzy_threshold: float = 85,
    semantic_threshold: float = 0.86,
    encode=sim.hashed_ngrams,
    case_sensitive: bool = True,
    fold_keys: bool = False,
) -> str:
    """A name for the options of :func:`match_terms`; other options give another one.

    One pass over each vocabulary.  An encoder counts by the expression that it makes.
    """
    words = one_per_term(abbreviations_df(spark) if vocabulary is None else vocabulary, fold_keys)
    known, _ = entries(spark, DIAGNOSES if diagnoses is None else diagnoses)
    parts = [RULES, table_digest(words), table_digest(known), float(fuzzy_threshold), float(semantic_threshold), encode("term"), case_sensitive, fold_keys]
    return spark.range(1).select(F.sha2(F.lit("\n".join(map(str, parts))), 256)).first()[0][:32]


def known_terms(spark: SparkSession, folder: str) -> DataFrame:
    """What a folder of matches holds, each term once; nothing if there is no such folder yet."""
    try:
        rows = spark.read.schema(MATCHES).parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], MATCHES)
    # two runs at the same time may have added the same terms, with the same result
    return rows.dropDuplicates(["term"])


def matched_terms(terms: DataFrame, folder: str, **options) -> tuple[DataFrame, DataFrame]:
    """``(matches, unseen)``: all matches of the distinct ``term`` values, and the terms that were matched in this run.

    ``options`` are those of :func:`match_terms` but given vectors, which are not part of a fingerprint.
    The new matches are written before they are read: a run that fails leaves what it had finished, or nothing.
    """
    if options.get("term_vectors") is not None:
        raise ValueError("matches of given vectors are not kept")
    spark = terms.sparkSession
    path = f"{folder.rstrip('/')}/{fingerprint(spark, **options)}"
    known = known_terms(spark, path)
    wanted = terms.select("term").filter("term IS NOT NULL")
    unseen = wanted.join(known.select("term"), "term", "left_anti")
    before = known.select("term")
    match_terms(unseen, **options).select("term", "standard", "score", "method").write.mode("append").parquet(path)
    now = known_terms(spark, path)
    return now, now.select("term").join(before, "term", "left_anti")


def cascade_with_dictionary(spans: DataFrame, folder: str, key: str = "record_id", **options) -> DataFrame:
    """As :func:`noteloom.operators.standardise.cascade`, with terms matched by earlier runs taken from ``folder``."""
    return cascade(spans, key, matched=lambda counts: matched_terms(counts, folder, **options)[0])
