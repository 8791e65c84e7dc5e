"""Clinical pattern extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.functions.patterns import CLINICAL_PATTERNS
from noteloom.functions.text import all_matches, col, first_match, lit, lits
from noteloom.operators.entities import Gazetteer, tagged_spans, wanted, with_gazetteer


def pattern_items(text: str, patterns: dict[str, str] | None = None) -> str:
    """``array<struct<pattern, ord, raw>>`` of all matches, ordered by pattern and position."""
    patterns = CLINICAL_PATTERNS if patterns is None else patterns
    items = [
        f"transform({all_matches(text, p, ignore_case=True)}, (pi_m, pi_i) -> "
        f"named_struct('pattern', {lit(name)}, 'ord', pi_i, 'raw', pi_m))"
        for name, p in patterns.items()
    ]
    return f"concat({', '.join(items)})"


def extract_patterns(notes: DataFrame, patterns: dict[str, str] | None = None, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Long table ``(key, pattern, ord, raw)``; a pattern without a match has no row."""
    items = F.expr(pattern_items(col(text), patterns))
    # the outer form keeps the optimizer from matching a second time in a filter
    long = notes.select(key, F.explode_outer(items).alias("i")).filter("i IS NOT NULL")
    return long.select(key, "i.pattern", "i.ord", "i.raw")


def extracted_patterns(extracted: DataFrame, key: str = "record_id") -> DataFrame:
    """The long table of :func:`extract_patterns` from written extractions."""
    lists = extracted.select(key, F.explode("extracted.vet_patterns").alias("pattern", "m"))
    return lists.select(key, "pattern", F.posexplode("m").alias("ord", "raw"))


def extract_one(notes: DataFrame, pattern: str, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Long table of a single clinical pattern."""
    return extract_patterns(notes, {pattern: CLINICAL_PATTERNS[pattern]}, text, key)


def pattern_map(text: str, patterns: dict[str, str] | None = None) -> str:
    """``map<pattern, array<raw>>`` holding only the patterns that matched."""
    patterns = CLINICAL_PATTERNS if patterns is None else patterns
    lists = ", ".join(all_matches(text, p, ignore_case=True) for p in patterns.values())
    return f"map_filter(map_from_arrays(array({lits(patterns)}), array({lists})), (pm_k, pm_v) -> size(pm_v) > 0)"


def first_of(text: str, pattern: str) -> str:
    """First match of a clinical pattern, NULL if there is none."""
    return first_match(text, CLINICAL_PATTERNS[pattern], ignore_case=True)


def extract_all(notes: DataFrame, gazetteer: Gazetteer | None = None, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Add ``extracted``: ``struct<ner_entities, vet_patterns>``.  ``key``, unique in ``notes``, is used only with a gazetteer table."""
    rows, tagged = notes, None
    if isinstance(gazetteer, DataFrame):
        rows, tagged = with_gazetteer(notes, gazetteer, text, key), tagged_spans(col(text), given="_given")
    entities = f"filter({tagged or tagged_spans(col(text), gazetteer)}, ea_s -> {wanted('ea_s.text', 'ea_s.label')})"
    extracted = F.expr(f"named_struct('ner_entities', {entities}, 'vet_patterns', {pattern_map(col(text))})").alias("extracted")
    return rows.select(*[c for c in notes.columns if c != "extracted"], extracted)
