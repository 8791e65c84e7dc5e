"""Schemas of the source rows and of the records passed on."""

from __future__ import annotations

SOURCE = "id STRING, sentence STRING, icd_label STRING, annonymisation STRING, disease STRING"

SPAN = "STRUCT<entity: STRING, label: STRING, start: INT, `end`: INT>"
ENTITY = "STRUCT<text: STRING, label: STRING, start: INT, `end`: INT>"
ITEM = (
    "STRUCT<ord: INT, raw: STRING, standard: STRING, category: STRING, value: DOUBLE, unit: STRING, "
    "score: DOUBLE, method: STRING>"
)
REDACTED = "STRUCT<text: STRING, type: STRING, start: INT, `end`: INT, placeholder: STRING>"

RECORD = f"""
record_id BIGINT,
raw_text STRING,
ground_truth STRUCT<icd_labels: ARRAY<STRING>, anon_spans: ARRAY<{SPAN}>, disease_spans: ARRAY<{SPAN}>>,
extracted STRUCT<ner_entities: ARRAY<{ENTITY}>, vet_patterns: MAP<STRING, ARRAY<STRING>>>,
standardised MAP<STRING, ARRAY<{ITEM}>>,
deidentified STRUCT<redacted_text: STRING, entities_found: ARRAY<{REDACTED}>>,
quality_scores MAP<STRING, STRUCT<before: DOUBLE, after: DOUBLE>>
"""
