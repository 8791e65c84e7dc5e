"""Six data-quality scores, before and after processing.

Every score is a ratio of two sums.  Each input table is read once and gives one small row of
sums; the rows are turned into ``(dimension, side, passed, checks)`` and divided at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions.patterns import CAPITALS_PATTERN
from noteloom.functions.text import all_matches, col
from noteloom.functions.vocabulary import RAW_CANONICAL
from noteloom.operators.standardise import MATCHED_METHODS

DIMENSIONS = ["Completeness", "Accuracy", "Consistency", "Validity", "Uniqueness", "Standardisation"]
OVERALL = "OVERALL"

# Accepted range of parsed values; an age must be above 0.
RANGES = {"weight": (0.1, 100), "temperature": (35, 42), "age": (0, 30)}

# Scores where there is nothing to check, and scores that do not depend on the data.
DEFAULTS = {"Consistency": 0.5}
CONSTANT_BEFORE = {"Consistency": 0.5, "Standardisation": 0.0}
MIN_TEXT = 5


def _sum(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


# (dimension, side, passed, checks) as expressions of the sums.
NOTE_PARTS = [
    ("Completeness", "before", "filled", "n * 3"),
    ("Completeness", "after", "filled + n * 3", "n * 6"),
    ("Accuracy", "before", "known", "words"),
    ("Validity", "before", "long_enough", "n"),
    ("Validity", "after", "long_enough", "n"),
]
UNIQUE_PARTS = [("Uniqueness", side, "`distinct`", "n") for side in ("before", "after")]


def _checks(one_row: DataFrame, parts: list[tuple[str, str, str, str]]) -> DataFrame:
    """``(dimension, side, passed, checks)`` from a single row of sums."""
    rows = F.array(
        *[
            F.struct(
                F.lit(d).alias("dimension"), F.lit(side).alias("side"),
                F.expr(p).cast("double").alias("passed"), F.expr(n).cast("double").alias("checks"),
            )
            for d, side, p, n in parts
        ]
    )
    return one_row.select(F.inline(rows))


def note_checks(notes: DataFrame, canonical: list[str] | None = None, text: str = "raw_text") -> DataFrame:
    """Checks on the notes themselves: ``(text, icd_labels, disease_spans)`` and capitals.

    ``icd_labels`` and ``disease_spans`` are arrays.  The three slots that processing adds to a
    record are always filled, so each counts as a passed check.
    """
    per_note = notes.select(*_note_facts(canonical, text))
    return _checks(per_note.agg(*_note_sums()), NOTE_PARTS)


def _note_facts(canonical: list[str] | None, text: str) -> list[Column]:
    """What the checks need of one note, as numbers."""
    canonical = RAW_CANONICAL if canonical is None else canonical
    words = F.expr(all_matches(col(text), CAPITALS_PATTERN))
    return [
        F.coalesce(F.length(text), F.lit(0)).alias("size"),
        F.coalesce(F.size("icd_labels"), F.lit(0)).alias("labels"),
        F.coalesce(F.size("disease_spans"), F.lit(0)).alias("spans"),
        F.size(words).alias("words"),
        F.size(F.filter(words, lambda w: w.isin(canonical))).alias("known"),
    ]


def _note_sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        (_sum(F.col("size") > 0) + _sum(F.col("labels") > 0) + _sum(F.col("spans") > 0)).alias("filled"),
        F.coalesce(F.sum("words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("known"), F.lit(0)).alias("known"),
        _sum(F.col("size") > MIN_TEXT).alias("long_enough"),
    ]


def _digests(columns: list[str]) -> list[Column]:
    """Keys by a 256-bit digest, so a shuffle moves 32 bytes per distinct text.  NULL is a value."""
    return [F.coalesce(F.unhex(F.sha2(F.col(c).cast("string").cast("binary"), 256)), F.lit(b"")).alias(f"_{c}") for c in columns]


def note_and_uniqueness_checks(notes: DataFrame, columns: list[str], canonical: list[str] | None = None, text: str = "raw_text") -> DataFrame:
    """Both kinds of checks in one pass: the sums of the notes are taken per distinct key, then over all keys."""
    facts = notes.select(*_digests(columns), *_note_facts(canonical, text))
    return _fact_checks(facts, [f"_{c}" for c in columns])


def _fact_checks(facts: DataFrame, keys: list[str]) -> DataFrame:
    groups = facts.groupBy(*keys).agg(*_note_sums())
    names = ("n", "filled", "words", "known", "long_enough")
    sums = groups.agg(F.count("*").alias("distinct"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names])
    return _checks(sums, NOTE_PARTS + UNIQUE_PARTS)


def with_note_facts(records: DataFrame, columns: list[str] | None = None, canonical: list[str] | None = None, text: str = "raw_text") -> DataFrame:
    """Records with ``note_facts``: the numbers and the digest that the checks need of a note, some dozen bytes, taken while its text is at hand."""
    truth = records.select("*", F.col("ground_truth.icd_labels").alias("icd_labels"), F.col("ground_truth.disease_spans.entity").alias("disease_spans"))
    keys = F.struct(*_digests(columns or [text])).alias("key")
    return truth.select(*records.columns, F.struct(*_note_facts(canonical, text), keys).alias("note_facts"))


def fact_checks(facts: DataFrame) -> DataFrame:
    """The checks of :func:`note_and_uniqueness_checks` from ``note_facts`` alone."""
    return _fact_checks(facts.select("note_facts.*"), ["key"])


def _in_range(value: Column, pattern: Column) -> Column:
    weight, temperature, age = RANGES["weight"], RANGES["temperature"], RANGES["age"]
    return (
        ((pattern == "weight") & value.between(*weight))
        | ((pattern == "temperature") & value.between(*temperature))
        | ((pattern == "age") & (value > age[0]) & (value <= age[1]))
    )


def item_checks(items: DataFrame, weight: str | None = None) -> DataFrame:
    """Checks on standardised items; ``weight`` names a column counting repeated rows."""
    times = F.lit(1) if weight is None else F.col(weight)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, times).otherwise(0)), F.lit(0))

    pattern, value, unit, method = (F.col(c) for c in ("pattern", "value", "unit", "method"))
    measured = pattern.isin(list(RANGES))
    diagnosis = pattern == "diagnoses"
    sums = items.agg(
        total(F.lit(True)).alias("n"),
        total(F.when(diagnosis, method != "unmatched").otherwise(method.isin("exact_match", "parsed"))).alias("accurate"),
        total(measured & value.isNotNull()).alias("values"),
        total(measured & value.isNotNull() & _in_range(value, pattern)).alias("in_range"),
        total(measured).alias("measured"),
        total(measured & value.isNotNull() & (unit.isNotNull() | (pattern == "temperature"))).alias("valid"),
        total(method.isin(MATCHED_METHODS)).alias("standard"),
    )
    return _checks(
        sums,
        [
            ("Accuracy", "after", "accurate", "n"),
            ("Consistency", "after", "in_range", "`values`"),
            ("Validity", "after", "valid", "measured"),
            ("Standardisation", "after", "standard", "n"),
        ],
    )


def uniqueness_checks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct key values against rows.  Keys are compared by a 256-bit digest, so a shuffle
    moves 32 bytes per distinct text and repeated texts are dropped before it.  NULL is a value."""
    groups = rows.select(*_digests(columns)).groupBy(*[f"_{c}" for c in columns]).agg(F.count("*").alias("n"))
    sums = groups.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return _checks(sums, UNIQUE_PARTS)


# Logarithm of a sketch's registers: the error of a count is about 1.04 / sqrt(2 ** LOG_REGISTERS), one standard deviation.
LOG_REGISTERS = 14


def distinct_sketches(rows: DataFrame, columns: list[str], by: list[str] | None = None, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``(*by, sketch, n)``: a mergeable sketch of the distinct keys of ``columns`` and the number of rows, for each group.

    Sketches of parts, days or stages are some kilobytes each, whatever their rows, and are kept and merged instead of
    the keys.  NULL is a value.
    """
    digest = F.sha2(F.concat(*_digests(columns)) if len(columns) == 1 else F.to_json(F.struct(*[F.hex(d).alias(c) for d, c in zip(_digests(columns), columns, strict=True)])).cast("binary"), 256)
    keyed = rows.select(*(by or []), digest.alias("_k"))
    return keyed.groupBy(*(by or [])).agg(F.hll_sketch_agg("_k", log_registers).alias("sketch"), F.count("*").alias("n"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of parts merged into those of whole groups."""
    return sketches.groupBy(*(by or [])).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n").alias("n"))


def approximate_uniqueness(sketches: DataFrame, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``sketches`` with ``distinct_keys``, ``uniqueness`` and ``error``, the relative error that three standard deviations allow."""
    found = sketches.withColumn("distinct_keys", F.hll_sketch_estimate("sketch")).drop("sketch")
    share = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("distinct_keys"), F.col("n")), F.lit(0.0)))
    return found.withColumn("uniqueness", share).withColumn("error", F.lit(3 * 1.04 / 2 ** (log_registers / 2)))


def scores(checks: DataFrame) -> DataFrame:
    """``(dimension, before, after)`` from check sums; dimensions without data get their default."""

    def default(side: str) -> Column:
        out = F.lit(0.0)
        for name, value in DEFAULTS.items():
            out = F.when(F.col("dimension") == name, value).otherwise(out)
        if side == "before":
            for name, value in CONSTANT_BEFORE.items():
                out = F.when(F.col("dimension") == name, value).otherwise(out)
        return out

    def side_ratio(side: str) -> Column:
        here = F.col("side") == side
        return F.coalesce(
            F.try_divide(F.sum(F.when(here, F.col("passed"))), F.sum(F.when(here, F.col("checks")))), default(side)
        ).alias(side)

    return checks.groupBy("dimension").agg(side_ratio("before"), side_ratio("after"))


def quality_checks(notes: DataFrame, items: DataFrame, key_columns: list[str] | None = None, canonical: list[str] | None = None, text: str = "raw_text", weight: str | None = None) -> DataFrame:
    """All checks; ``items`` is the standardised table, or its counts with their column as ``weight``."""
    return note_and_uniqueness_checks(notes, key_columns or [text], canonical, text).unionByName(item_checks(items, weight))


def quality_scores(notes: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``(dimension, before, after)`` of the six dimensions."""
    return scores(quality_checks(notes, items, **options))


def quality_report(six: DataFrame) -> DataFrame:
    """The six dimensions with their change, and their unweighted mean as a last row; the scores are computed once."""
    rows = six.agg(F.collect_list(F.struct("dimension", "before", "after")).alias("rows"))

    def mean(side: str) -> Column:
        total = F.aggregate(F.col("rows")[side], F.lit(0.0), lambda s, x: s + x)
        return F.try_divide(total, F.size("rows")).alias(side)

    overall = F.struct(F.lit(OVERALL).alias("dimension"), mean("before"), mean("after"))
    every = rows.select(F.inline(F.concat("rows", F.array(overall))))
    return every.select("dimension", "before", "after", (F.col("after") - F.col("before")).alias("delta"))


def attach_scores(records: DataFrame, six: DataFrame) -> DataFrame:
    """Add ``quality_scores``, the same map for every record (six entries, one value per job)."""
    entries = F.collect_list(F.struct("dimension", F.struct("before", "after").alias("v")))
    return records.withColumn("quality_scores", six.agg(F.map_from_entries(entries)).scalar())
