"""Time the headline queries.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) say where and on
how much.  Prints one JSON line; each query is run whole into a sink that discards its rows.  ``queries`` are first runs of a
session, ``warm`` second ones, which tell a slower query from a slower start.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from noteloom.plans.queries import registered
from noteloom.session import local_session

HEADLINE = [
    "pattern_methods",
    "extract_patterns_long",
    "standardised_long",
    "fuzzy_match_diagnosis",
    "fuzzy_match_weighted",
    "semantic_match",
    "cascade_misspelt",
    "fallback_label",
    "pii_spans",
    "pii_email_documents",
    "redact_structured",
    "deidentify_notes",
    "entities_all",
    "k_before_after",
    "k_mitigated",
    "deid_eval_scores",
    "quality_uniqueness_documents",
    "quality_report",
    "attach_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries, times, warm = registered(), {}, {}
    # the first job of a session pays for starting it
    queries["scan_notes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for taken in (times, warm):
        for name in HEADLINE:
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name] = round(time.perf_counter() - start, 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "warm": warm, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
