"""What may leave the safe zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(records: DataFrame) -> DataFrame:
    """Records without raw text, annotations, span texts or values that were not generalised.

    Keeps the redacted text, the type and placeholder of each entity, the pattern lists of all families, those
    of age and weight as they were generalised, standard terms with their methods, and the quality scores.  An
    unmatched term has no standard one: what stands there is the text of its span, which is left out.
    """
    hidden = F.array(F.lit("age"), F.lit("weight"))
    return records.select(
        "record_id",
        F.col("deidentified.redacted_text").alias("redacted_text"),
        F.transform(
            "deidentified.entities_found",
            lambda e: F.struct(e["type"].alias("type"), e["placeholder"].alias("placeholder")),
        ).alias("entities"),
        F.col("extracted.vet_patterns").alias("patterns"),
        F.transform_values(
            F.map_filter("standardised", lambda k, _: ~F.array_contains(hidden, k)),
            lambda _, items: F.transform(
                items, lambda i: F.struct(F.when(i["method"] != "unmatched", i["standard"]).alias("standard"), i["value"].alias("value"), i["unit"].alias("unit"), i["method"].alias("method"))
            ),
        ).alias("standardised"),
        "quality_scores",
    )
