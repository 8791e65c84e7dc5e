"""De-identification: structured identifiers first, then names in what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.functions import spans as S
from noteloom.functions.patterns import IDENTIFIER_PATTERNS
from noteloom.functions.text import col, lits
from noteloom.operators.entities import REDACTED_TYPES, Gazetteer, keep_redactable, tagged_spans, with_gazetteer


def identifier_spans(text: str, patterns: dict[str, str]) -> str:
    """Every match of every identifier pattern, unmerged."""
    return "concat(" + ", ".join(S.pattern_spans(text, p, i) for i, p in enumerate(patterns.values())) + ")"


def structured_redaction(text: str, patterns: dict[str, str] | None = None) -> str:
    """``struct<redacted_text, entities>`` with structured identifiers replaced by ``[TYPE_n]``.

    Overlapping matches are replaced as one, so no part of any match survives.
    """
    patterns = patterns or IDENTIFIER_PATTERNS
    merged = S.merge_overlapping(identifier_spans(text, patterns))
    return S.redaction(text, merged, list(patterns), by_rank=True)


def entity_redaction(text: str, tagged: str) -> str:
    """``struct<redacted_text, entities>`` with the redactable ones among ``tagged`` replaced."""
    return S.redaction(text, S.merge_overlapping(keep_redactable(tagged)), REDACTED_TYPES, by_rank=False)


def find_pii(notes: DataFrame, patterns: dict[str, str] | None = None, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Long table of identifier matches with offsets, before any merging."""
    patterns = patterns or IDENTIFIER_PATTERNS
    spans = F.expr(identifier_spans(col(text), patterns))
    # the outer form keeps the optimizer from evaluating the array a second time in a filter
    long = notes.select(key, text, F.explode_outer(spans).alias("s")).filter("s IS NOT NULL")
    return long.select(
        key,
        F.expr(f"get(array({lits(patterns)}), s.rank)").alias("type"),
        F.expr(S.slice_text(col(text), "s.start", "s.stop")).alias("text"),
        F.col("s.start").alias("start"),
        F.col("s.stop").alias("end"),
    )


def redact_structured(notes: DataFrame, patterns: dict[str, str] | None = None, text: str = "raw_text") -> DataFrame:
    """Add ``redacted_text`` and ``entities`` of :func:`structured_redaction`."""
    done = notes.select("*", F.expr(structured_redaction(col(text), patterns)).alias("_r"))
    return done.select(*notes.columns, "_r.redacted_text", "_r.entities")


def redact_entities(notes: DataFrame, gazetteer: Gazetteer | None = None, text: str = "raw_text", spans: str | None = None, key: str = "record_id") -> DataFrame:
    """Replace names, organisations and places; adds ``redacted_text`` and ``entities``.

    Spans come from :func:`tagged_spans` or, if given, from column ``spans``
    (``array<struct<text, label, start, end>>`` on the same text).  ``key``, unique in ``notes``, is used only
    with a gazetteer table.
    """
    rows, tagged = notes, col(spans) if spans else None
    if tagged is None and isinstance(gazetteer, DataFrame):
        rows, tagged = with_gazetteer(notes, gazetteer, text, key), tagged_spans(col(text), given="_given")
    done = rows.select("*", F.expr(entity_redaction(col(text), tagged or tagged_spans(col(text), gazetteer))).alias("_r"))
    return done.select(*notes.columns, "_r.redacted_text", "_r.entities")


def deidentify(
    notes: DataFrame,
    gazetteer: Gazetteer | None = None,
    patterns: dict[str, str] | None = None,
    text: str = "raw_text",
    spans: str | None = None,
    key: str = "record_id",
) -> DataFrame:
    """Both redactions in a chain; adds ``redacted_text``, ``entities`` (both lists) and ``n_structured``.

    Offsets of the first ``n_structured`` entities refer to the note, those of the others to
    the note with its structured identifiers replaced.  Names come from cues and the gazetteer, lists or a table
    of any size, or from column ``spans`` (``array<struct<text, label, start, end>>``), found by a model of your own on the
    text that :func:`redact_structured` gives.  ``key``, unique in ``notes``, is used only with a table.
    """
    # a column each: as one expression the two would be nested deeper than the analyzer goes
    first = notes.select("*", F.expr(structured_redaction(col(text), patterns)).alias("_r1"))
    first = first.withColumn("_text", F.col("_r1.redacted_text"))
    if spans is not None:
        tagged = col(spans)
    elif isinstance(gazetteer, DataFrame):
        first, tagged = with_gazetteer(first, gazetteer, "_text", key), tagged_spans("_text", given="_given")
    else:
        tagged = tagged_spans("_text", gazetteer)
    second = first.select("*", F.expr(entity_redaction("_text", tagged)).alias("_r2"))
    whole = F.struct(
        F.col("_r2.redacted_text").alias("redacted_text"), F.col("_r1.entities").alias("structured"), F.col("_r2.entities").alias("named")
    )
    done = second.select(*notes.columns, whole.alias("_r"))
    return done.select(
        *notes.columns,
        F.col("_r.redacted_text").alias("redacted_text"),
        F.concat("_r.structured", "_r.named").alias("entities"),
        F.size("_r.structured").alias("n_structured"),
    )


def entities_long(redacted: DataFrame, key: str = "record_id", n_structured: str | None = None) -> DataFrame:
    """One row per entity; ``frame`` tells which text the offsets refer to."""
    structured = F.lit(True) if n_structured is None else F.col("pos") < F.col(n_structured)
    extra = [] if n_structured is None else [n_structured]
    long = redacted.select(key, *extra, F.posexplode_outer("entities").alias("pos", "e")).filter("pos IS NOT NULL")
    return long.select(
        key,
        F.col("pos").alias("ord"),
        *[F.col(f"e.{c}").alias(c) for c in ("type", "text", "start", "end", "placeholder")],
        F.when(structured, "raw").otherwise("regex_redacted").alias("frame"),
    )


def pii_counts(found: DataFrame) -> DataFrame:
    """Matches and distinct matched texts per type."""
    return found.groupBy("type").agg(F.count("*").alias("n_matches"), F.countDistinct("text").alias("n_values"))
