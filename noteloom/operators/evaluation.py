"""Span detection against annotations, by text containment within a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _distinct_lower(texts: Column) -> Column:
    return F.array_distinct(F.transform(texts, lambda t: F.lower(t)))


def _touches(one: Column, others: Column) -> Column:
    return F.exists(others, lambda o: F.contains(o, one) | F.contains(one, o))


def span_counts(records: DataFrame, gold: str, found: str, key: str = "record_id") -> DataFrame:
    """``(key, tp, fn, fp)`` for records with at least one gold text.

    ``gold`` and ``found`` are array columns; texts count once per record, ignoring case, and
    match if one contains the other.
    """
    sets = records.filter(F.size(gold) > 0).select(
        key, _distinct_lower(F.col(gold)).alias("g"), _distinct_lower(F.col(found)).alias("f")
    )
    hits = sets.select(
        key,
        F.size("g").alias("n_gold"),
        F.size(F.filter("g", lambda g: _touches(g, F.col("f")))).alias("tp"),
        F.size(F.filter("f", lambda f: ~_touches(f, F.col("g")))).alias("fp"),
    )
    return hits.select(key, F.col("tp"), (F.col("n_gold") - F.col("tp")).alias("fn"), "fp")


def evaluate_spans(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 over all records; 0 where nothing is there to divide by."""
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("tp", "fn", "fp")])
    zero = F.lit(0.0)
    rates = sums.select(
        "tp", "fn", "fp",
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return rates.select("*", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), zero).alias("f1"))
