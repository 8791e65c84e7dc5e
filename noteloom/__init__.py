"""Analytics over large tables of short clinical notes, as composable Spark operators."""

from noteloom.operators.deidentify import deidentify, entities_long, find_pii, pii_counts, redact_entities, redact_structured
from noteloom.operators.entities import filter_entity_spans, filter_spans_smart, gazetteer_spans, tag_entities
from noteloom.operators.evaluation import evaluate_spans, span_counts
from noteloom.operators.extract import extract_all, extract_patterns
from noteloom.operators.matching import fuzzy_join, label_top1, vector_join, weighted_fuzzy_join
from noteloom.operators.privacy import (
    generalise,
    generalise_age,
    generalise_weight,
    k_anonymity,
    k_before_after,
    k_groups,
    k_members,
    k_summary,
    mitigate,
    mitigated_patterns,
    quasi_keys,
)
from noteloom.operators.publish import publish
from noteloom.operators.quality import attach_scores, quality_report, quality_scores
from noteloom.operators.standardise import (
    cascade,
    fallback_label,
    method_distribution,
    parse_values,
    standardise,
    standardise_patterns,
    standardised_map,
)
from noteloom.sources.annotations import parse_annotations
from noteloom.sources.notes import read_notes, read_records, shape_records, write_records

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("operators", "sources", "functions")]
