"""Standardisation: abbreviation lookup, value parsing and the diagnosis cascade."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions import similarity as sim
from noteloom.functions.text import NUMBER, col, first_match, first_number, lit, to_number
from noteloom.functions.vocabulary import DIAGNOSES, NOTE_LABELS, abbreviations_df, terms_df
from noteloom.operators.extract import extract_patterns
from noteloom.operators.matching import best_label, entries, fuzzy_best, label_top1, spread_terms, vector_best
from noteloom.operators.skew import heavy_keys, salted_join

# Unit texts per parsed pattern, in the order they are tried.
UNITS = {
    "age": r"(?:years?|months?|wks?|weeks?|yo|yr)",
    "weight": r"(?:kg|lbs|g)",
    "dosage": r"(?:mg/kg|mg|ml|IU|mcg)",
}
DEGREES = "°C"
# Places that the rows of one key are dealt to when they meet a vocabulary of any size.
PLACES = 16
# Notes of one id that are made again at once.
COPIES = 1 << 16

STANDARD_COLUMNS = ["record_id", "pattern", "ord", "raw", "standard", "category", "value", "unit", "score", "method"]
# A record without annotated diagnoses.
NO_SPANS = "coalesce(size(ground_truth.disease_spans), 0) <= 0"
# Methods that count as standardised.
MATCHED_METHODS = ["exact_match", "fuzzy_match", "semantic_match", "zero_shot", "parsed"]


def lookup_key(raw: str) -> Column:
    """The leading letters of a match, or all of it if it starts otherwise."""
    return F.expr(f"coalesce(regexp_substr({raw}, '^[A-Za-z]+'), {raw})")


def parsed_unit(pattern: str, raw: str) -> str:
    """Unit of a parsed value; NULL for patterns that are not parsed."""

    def found(name: str) -> str:
        return f"coalesce({first_match(raw, UNITS[name], ignore_case=True)}, 'unknown')"

    return f"""CASE {pattern} WHEN 'age' THEN {found('age')} WHEN 'temperature' THEN {lit(DEGREES)}
      WHEN 'weight' THEN lower({found('weight')}) WHEN 'dosage' THEN {found('dosage')} END"""


def parse_values(patterns: DataFrame) -> DataFrame:
    """Add ``value``, ``unit`` and ``method`` (parsed or unmatched) to a long pattern table."""
    digits = patterns.select(
        "*", F.expr(first_match("raw", NUMBER)).alias("_digits"), F.expr(parsed_unit("pattern", "raw")).alias("_unit")
    )
    numbers = digits.select(*patterns.columns, F.expr(to_number("_digits")).alias("_number"), "_unit")
    parsed = F.col("_number").isNotNull() & F.col("_unit").isNotNull()
    return numbers.select(
        *patterns.columns,
        F.when(parsed, F.col("_number")).alias("value"),
        F.when(parsed, F.col("_unit")).alias("unit"),
        F.when(parsed, "parsed").otherwise("unmatched").alias("method"),
    )


def one_per_term(vocabulary: DataFrame, fold_keys: bool = False) -> DataFrame:
    """``(term, canonical, category)`` with one row for each term, the last by ``ord``; terms in capitals with ``fold_keys``.

    Without ``ord``, or where it is the same, the last by canonical term and category.
    """
    term = F.upper("term") if fold_keys else F.col("term")
    order = ["ord"] if "ord" in vocabulary.columns else []
    last = F.max(F.struct(*order, "canonical", "category")).alias("last")
    return vocabulary.groupBy(term.alias("term")).agg(last).select("term", "last.canonical", "last.category")


def lookup(rows: DataFrame, key: Column, vocabulary: DataFrame, fold_keys: bool = False, places: int = PLACES) -> DataFrame:
    """Add ``standard`` and ``category`` of the vocabulary term equal to the upper-cased key, else
    to the key as it is.  ``fold_keys`` compares without regard to case instead.

    Of entries for one term, or for one folded term, the last by ``ord`` counts: every row stays one row.  The rows of
    a key are dealt to ``places`` by their own hash, and the entries copied to each, so a key in nearly every note is not one task's.
    """
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(places)).cast("int") if places > 1 else F.lit(0)
    rows = rows.select("*", key.alias("_key"), place.alias("_place"))
    entries = one_per_term(vocabulary, fold_keys).withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(places - 1))) if places > 1 else F.lit(0))

    def joined(left: DataFrame, own: Column, n: int) -> DataFrame:
        names = {"term": "_t", "canonical": "_c", "category": "_g", "_p": "_p"}
        side = entries.select(*[F.col(c).alias(f"{name}{n}") for c, name in names.items()])
        return left.join(side, (own == F.col(f"_t{n}")) & (F.col("_place") == F.col(f"_p{n}")), "left")

    out = joined(rows, F.upper("_key"), 1)
    if not fold_keys:
        out = joined(out, F.col("_key"), 2)
    own = [c for c in rows.columns if c not in ("_key", "_place")]
    found = {c: [F.col(f"_{c}{n}") for n in ((1,) if fold_keys else (1, 2))] for c in ("c", "g")}
    return out.select(*own, F.coalesce(*found["c"]).alias("standard"), F.coalesce(*found["g"]).alias("category"))


def standardise_patterns(patterns: DataFrame, vocabulary: DataFrame | None = None, fold_keys: bool = False) -> DataFrame:
    """Long standardised table of pattern matches: looked up, else parsed, else unmatched."""
    # the shipped vocabulary goes to every task anyway
    places = 1 if vocabulary is None else PLACES
    vocabulary = abbreviations_df(patterns.sparkSession) if vocabulary is None else vocabulary
    found = lookup(parse_values(patterns), lookup_key("raw"), vocabulary, fold_keys, places)
    exact = F.col("standard").isNotNull()
    return found.select(
        *patterns.columns,
        "standard",
        "category",
        F.when(~exact, F.col("value")).alias("value"),
        F.when(~exact, F.col("unit")).alias("unit"),
        F.lit(None).cast("double").alias("score"),
        F.when(exact, "exact_match").otherwise(F.col("method")).alias("method"),
    )


def with_vital_value(standardised: DataFrame) -> DataFrame:
    """Add ``vital_value``: the number inside a vital sign, which the lookup itself leaves out."""
    return standardised.withColumn(
        "vital_value", F.when(F.col("pattern") == "vital_sign", F.expr(first_number("raw")))
    )


# Makes a vector expression (array<float>) from a text expression.
Encoder = Callable[[str], str]


def encoded_terms(terms: DataFrame, encode: Encoder = sim.hashed_ngrams) -> DataFrame:
    """``(term, ord, vector)`` of a vocabulary."""
    return terms.select("term", "ord", F.expr(encode("term")).alias("vector"))


def match_terms(
    terms: DataFrame,
    vocabulary: DataFrame | None = None,
    diagnoses: list[str] | DataFrame | None = None,
    fuzzy_threshold: float = 85,
    semantic_threshold: float = 0.86,
    encode: Encoder = sim.hashed_ngrams,
    case_sensitive: bool = True,
    fold_keys: bool = False,
    term_vectors: DataFrame | None = None,
    diagnosis_vectors: DataFrame | None = None,
) -> DataFrame:
    """The cascade on distinct ``term`` values: exact, then fuzzy, then semantic, then unmatched.

    Adds ``standard``, ``score`` and ``method``.  A later tier is evaluated only for terms that
    the earlier ones left open, and terms are matched once however often they occur.

    Vectors made elsewhere are given together: ``term_vectors (term, vector)``, one row a term, and ``diagnosis_vectors
    (term, ord, vector)``; they take the place of ``encode``.  A term without a vector is similar to nothing.
    """
    if (term_vectors is None) != (diagnosis_vectors is None):
        raise ValueError("vectors of terms and of diagnoses are given together or not at all")
    spark = terms.sparkSession
    vocabulary = abbreviations_df(spark) if vocabulary is None else vocabulary
    diagnoses = DIAGNOSES if diagnoses is None else diagnoses
    table, large = entries(spark, diagnoses)

    # each term is there once
    looked_up = lookup(spread_terms(terms, "term"), F.col("term"), vocabulary, fold_keys, 1).drop("category").withColumnRenamed("standard", "_exact")
    fuzzy = fuzzy_best(looked_up, table, fuzzy_threshold, case_sensitive, unless="_exact IS NOT NULL", large=large).withColumnRenamed("best", "_fuzzy")
    found = "_exact IS NOT NULL OR _fuzzy IS NOT NULL"
    if term_vectors is not None:
        given = term_vectors.select(F.col("term").alias("_term"), F.col("vector").alias("_vector"))
        fuzzy = fuzzy.join(given, F.col("term") == F.col("_term"), "left").drop("_term")
        semantic = vector_best(fuzzy, diagnosis_vectors, "_vector", semantic_threshold, unless=found)
    elif large:
        semantic = vector_best(fuzzy, encoded_terms(table, encode), encode("term"), semantic_threshold, unless=found)
    else:  # a list is part of the query anyway
        nearest = best_label(encode("term"), encoded_terms(table, encode), semantic_threshold)
        semantic = fuzzy.select("*", F.explode_outer(F.expr(f"array(if({found}, NULL, {nearest}))")).alias("best"))
    semantic = semantic.withColumnRenamed("best", "_semantic")
    return semantic.select(
        *terms.columns,
        F.coalesce("_exact", "_fuzzy.term", "_semantic.term", "term").alias("standard"),
        F.coalesce("_fuzzy.score", "_semantic.score").alias("score"),
        F.when(F.col("_exact").isNotNull(), "exact_match")
        .when(F.col("_fuzzy").isNotNull(), "fuzzy_match")
        .when(F.col("_semantic").isNotNull(), "semantic_match")
        .otherwise("unmatched")
        .alias("method"),
    )


def term_counts(spans: DataFrame, entity: str = "entity") -> DataFrame:
    """Distinct diagnosis terms with their number of spans."""
    return spans.groupBy(F.col(entity).alias("term")).agg(F.count("*").alias("n_spans"))


def cascade(spans: DataFrame, key: str = "record_id", matched: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """Diagnosis rows of the standardised long table from spans ``(key, ord, entity)``.

    Distinct terms are matched and joined back; very common terms are salted.  ``matched`` may find the matches of the terms in
    another way than by :func:`match_terms`; terms that it does not give are unmatched.
    """
    counts = term_counts(spans)
    matched = (matched(counts) if matched else match_terms(counts, **options)).select("term", "standard", "score", "method")
    rows = spans.select(key, "ord", F.col("entity").alias("term"))
    out = salted_join(rows, matched, ["term"], heavy_keys(counts, ["term"], "n_spans"), key)
    return out.select(
        key,
        F.lit("diagnoses").alias("pattern"),
        "ord",
        F.col("term").alias("raw"),
        "standard",
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("unit"),
        "score",
        F.coalesce("method", F.lit("unmatched")).alias("method"),
    )


def method_distribution(spans: DataFrame, **options) -> DataFrame:
    """Number of diagnosis spans per method, from the distinct terms alone."""
    return match_terms(term_counts(spans), **options).groupBy("method").agg(F.sum("n_spans").alias("n"))


def item_counts(notes: DataFrame, spans: DataFrame, patterns: DataFrame | None = None, **options) -> DataFrame:
    """``(pattern, value, unit, method, n)``: what scores need of the standardised table.

    Diagnoses stay distinct terms with their number of spans; nothing is joined back.
    """
    patterns = extract_patterns(notes) if patterns is None else patterns
    items = standardise_patterns(patterns).select("pattern", "value", "unit", "method", F.lit(1).cast("bigint").alias("n"))
    terms = match_terms(term_counts(spans), **options).select(
        F.lit("diagnoses").alias("pattern"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("unit"),
        "method",
        F.col("n_spans").alias("n"),
    )
    return items.unionByName(terms)


def fallback_label(
    notes: DataFrame,
    bare: str,
    labels: list[str] | None = None,
    threshold: float = 0.2,
    encode: Encoder = sim.hashed_ngrams,
    text: str = "raw_text",
    key: str = "record_id",
    scores: DataFrame | None = None,
) -> DataFrame:
    """Diagnosis rows for notes that have none: the label most similar to the whole note, if it reaches
    ``threshold``.  ``bare`` is a condition on the note's own columns that says it has none, so no note leaves its row.

    With ``scores (key, label, ord, score)``, such as :func:`noteloom.operators.labels.scored_notes` makes, the best of these is
    taken instead.
    """
    if scores is not None:
        best = label_top1(scores, threshold, key).select(F.col(key).alias("_key"), F.struct("score", F.col("label").alias("term")).alias("best"))
        return _labelled(notes.filter(bare).select(key).join(best, F.col(key) == F.col("_key")), key)
    labels = NOTE_LABELS if labels is None else labels
    vectors = encoded_terms(terms_df(notes.sparkSession, labels), encode)
    rows = notes.filter(bare).select(key, text)
    best = rows.select(key, F.explode(F.expr(f"array({best_label(encode(col(text)), vectors, threshold)})")).alias("best"))
    return _labelled(best.filter("best IS NOT NULL"), key)


def _labelled(best: DataFrame, key: str) -> DataFrame:
    return best.select(
        key,
        F.lit("diagnoses").alias("pattern"),
        F.lit(0).alias("ord"),
        F.lit(None).cast("string").alias("raw"),
        F.col("best.term").alias("standard"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("unit"),
        F.col("best.score").alias("score"),
        F.lit("zero_shot").alias("method"),
    )


def standardise(
    notes: DataFrame, spans: DataFrame, patterns: DataFrame | None = None, use_fallback: bool = False, bare: str = NO_SPANS, match_folder: str | None = None, **options
) -> DataFrame:
    """The standardised long table of notes and their diagnosis spans.

    With ``use_fallback`` notes that are ``bare``, by default records without annotated diagnoses, get a label.  With
    ``match_folder`` matched terms are kept there and only new ones are matched (:mod:`noteloom.operators.dictionary`).
    """
    patterns = extract_patterns(notes) if patterns is None else patterns
    if match_folder:
        from noteloom.operators.dictionary import cascade_with_dictionary  # which is built on this module

        diagnoses = cascade_with_dictionary(spans, match_folder, **options)
    else:
        diagnoses = cascade(spans, **options)
    if use_fallback:
        diagnoses = diagnoses.unionByName(fallback_label(notes, bare, encode=options.get("encode", sim.hashed_ngrams)))
    return standardise_patterns(patterns).unionByName(diagnoses).select(*STANDARD_COLUMNS)


def standardised_map(standardised: DataFrame, notes: DataFrame, key: str = "record_id") -> DataFrame:
    """``(key, standardised)``: one map per note, pattern to its items in order; the entry
    ``diagnoses`` is always there.

    Notes and items meet in one grouping, whose lists are made before the shuffle: one row of a note moves, not one of each item, and
    after the shuffle nothing is sorted but these.
    """
    fields = ["ord", "raw", "standard", "category", "value", "unit", "score", "method"]
    types = list(zip(fields, ["int", *["string"] * 3, "double", "string", "double", "string"], strict=True))
    whole = f"struct<{','.join(f'{f}:{t}' for f, t in [('pattern', 'string'), *types])}>"
    items = standardised.filter(F.col(key).isNotNull()).select(key, F.struct("pattern", *fields).cast(whole).alias("item"))
    both = notes.select(key, F.lit(None).cast(whole).alias("item")).union(items)  # a row without an item is a note's
    found = both.groupBy(key).agg(F.sort_array(F.collect_list("item")).alias("items"), F.count_if(F.col("item").isNull()).alias("n"))
    own = f"transform(filter(items, i -> i.pattern = p), i -> named_struct({', '.join(f"'{f}', i.{f}" for f in fields)}))"
    one = F.expr(f"map_from_entries(transform(array_union(items.pattern, array('diagnoses')), p -> struct(p, {own})))")
    # an id that notes share, or that is missing, is counted, and its notes are made again some at a time
    blocks = found.filter("n > 0").select(key, "items", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES))).alias("at"))
    copies = F.array_repeat(one, F.least(F.col("n") - F.col("at"), F.lit(COPIES)).cast("int"))
    return blocks.select(F.col(key).cast(notes.schema[key].dataType).alias(key), F.explode(copies).alias("standardised"))
