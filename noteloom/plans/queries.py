"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.functions.patterns import CLINICAL_PATTERNS, IDENTIFIER_PATTERNS
from noteloom.functions.vocabulary import BREEDS, DIAGNOSES, abbreviations_df
from noteloom.operators import deidentify as deid
from noteloom.operators import dictionary, evaluation, labels, matching, privacy, quality
from noteloom.operators import entities as ent
from noteloom.operators import extract as ext
from noteloom.operators import standardise as std
from noteloom.operators.publish import publish
from noteloom.plans import inputs
from noteloom.sources.annotations import parse_annotations
from noteloom.sources.folders import fresh_folder
from noteloom.sources.notes import read_records, shape_records, write_records

Query = Callable[[SparkSession, str], DataFrame]

# The hashed n-gram encoder is much coarser than a language model, so its queries use this
# threshold in place of the default.
NGRAM_THRESHOLD = 0.5
# The given vectors are spread out: the nearest label mean is rarely closer than this.
VECTOR_THRESHOLD = 0.22
# Names within longer texts are about so near.
PART_THRESHOLD = 0.62
# About half of the users have an event type with more than this share of their events.
LABEL_SHARE = 0.25
CASCADE = {"semantic_threshold": NGRAM_THRESHOLD}

CUSTOMER_KEYS = ["nation", "segment", "balance"]
CUSTOMER_RULES = {"balance": lambda c: F.when(F.substring(c, 1, 1) == "-", "negative").otherwise("positive")}


def _out(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as BIGINT, doubles rounded, so that results compare across engines."""
    types = dict(rows.dtypes)
    return rows.select(
        *[
            F.col(c).cast("bigint").alias(c)
            if types[c] == "int"
            else F.round(c, digits).alias(c)
            if types[c] == "double"
            else F.col(c)
            for c in rows.columns
        ]
    )


_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(fn(spark, sf_dir))

    _QUERIES[fn.__name__] = run
    return fn


def on_notes(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a query that needs only the notes."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(fn(inputs.notes(spark, sf_dir)))

    _QUERIES[fn.__name__] = run
    return fn


# --- sources ---------------------------------------------------------------------------------


@on_notes
def scan_notes(notes):
    return notes.select("record_id", "raw_text", "disease")


@query
def parse_annotations_rows(spark, sf_dir):
    parsed = parse_annotations(inputs.source_rows(spark, sf_dir))
    long = parsed.select(F.col("id").cast("bigint").alias("record_id"), F.posexplode_outer("disease").alias("ord", "s"))
    return long.filter("ord IS NOT NULL").select(
        "record_id", "ord", *[F.col(f"s.{c}").alias(c) for c in ("entity", "label", "start", "end")]
    )


@query
def shape_records_rows(spark, sf_dir):
    return _shaped(shape_records(parse_annotations(inputs.source_rows(spark, sf_dir))))


@query
def round_trip_records(spark, sf_dir):
    """Records written as Parquet, these read and written as JSON lines, and those read back."""
    records = shape_records(parse_annotations(inputs.source_rows(spark, sf_dir)))
    folder = fresh_folder(spark, "records")
    write_records(records, f"{folder}/parquet")
    write_records(read_records(spark, f"{folder}/parquet"), f"{folder}/json", "json")
    return _shaped(read_records(spark, f"{folder}/json", "json"))


def _shaped(records: DataFrame) -> DataFrame:
    truth = "ground_truth"
    return records.select(
        "record_id",
        "raw_text",
        F.array_join(f"{truth}.icd_labels", "|").alias("icd_labels"),
        F.array_join(f"{truth}.anon_spans.entity", "|").alias("anon_spans"),
        F.size(f"{truth}.disease_spans").alias("n_disease_spans"),
    )


@on_notes
def vocab_by_category(notes):
    vocabulary = abbreviations_df(notes.sparkSession)
    hits = std.standardise_patterns(ext.extract_patterns(notes), vocabulary).filter("method = 'exact_match'")
    per_category = hits.groupBy("category").agg(F.count("*").alias("n_hits"))
    terms = vocabulary.groupBy("category").agg(F.count("*").alias("n_terms"))
    return terms.join(per_category, "category", "left").select(
        "category", "n_terms", F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits")
    )


# --- extraction ------------------------------------------------------------------------------


def _extract(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(ext.extract_one(inputs.notes(spark, sf_dir), name))

    _QUERIES[f"extract_{name}"] = run


for _name in CLINICAL_PATTERNS:
    _extract(_name)


@on_notes
def extract_patterns_long(notes):
    return ext.extract_patterns(notes)


@on_notes
def filter_entity_spans(notes):
    return ent.filter_entity_spans(inputs.given_spans(notes))


@on_notes
def tag_entities(notes):
    return ent.tag_entities(notes)


@on_notes
def extract_all(notes):
    both = ext.extract_all(notes).select("record_id", "extracted")
    return both.select(
        "record_id",
        F.size("extracted.ner_entities").alias("n_entities"),
        F.size("extracted.vet_patterns").alias("n_patterns"),
        F.aggregate(F.map_values("extracted.vet_patterns"), F.lit(0), lambda n, m: n + F.size(m)).alias("n_matches"),
    )


@query
def tag_gazetteer(spark, sf_dir):
    """Names from a table of any size, of one to six words, under the same rules as the cues."""
    return ent.tag_entities(inputs.named_notes(spark, sf_dir), inputs.gazetteer(spark, sf_dir))


# --- standardisation -------------------------------------------------------------------------


@on_notes
def standardise_exact(notes):
    return std.standardise_patterns(ext.extract_patterns(notes)).drop("score")


@on_notes
def parse_values(notes):
    return std.parse_values(ext.extract_patterns(notes))


@query
def fuzzy_match_diagnosis(spark, sf_dir):
    terms = inputs.misspelt_diagnoses(spark, sf_dir).groupBy("term").agg(F.count("*").alias("n"))
    return matching.fuzzy_join(terms, DIAGNOSES)


@query
def fuzzy_match_weighted(spark, sf_dir):
    terms = inputs.misspelt_breeds(spark, sf_dir).groupBy("term").agg(F.count("*").alias("n"))
    return matching.weighted_fuzzy_join(terms, BREEDS)


@query
def fuzzy_match_parts(spark, sf_dir):
    """Vocabulary from a table: the distinct part names, ordered by name."""
    terms = inputs.misspelt_parts(spark, sf_dir).groupBy("term").agg(F.count("*").alias("n"))
    names = inputs.table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("ord"))
    return matching.weighted_fuzzy_join(terms, names)


def _label_vectors(vectors: DataFrame) -> DataFrame:
    """Mean vector of each label, as a vocabulary ``(term, ord, vector)``."""
    means = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    return means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("vector")).select(
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("term"), F.col("label").alias("ord"), "vector"
    )


@query
def semantic_match(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings")
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"))
    return matching.vector_join(rows, _label_vectors(vectors), VECTOR_THRESHOLD, "vec_id").drop("vector")


@query
def label_top1(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings")
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"))
    best = matching.vector_join(rows, _label_vectors(vectors), 0.2, "vec_id")
    return best.filter("matched IS NOT NULL").select("vec_id", F.col("matched").alias("label"), "score")


@query
def label_top1_scores(spark, sf_dir):
    """Scores from a relation: the share of each event type among a user's events."""
    events = inputs.table(spark, sf_dir, "events")
    parts = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    totals = parts.groupBy("user_id").agg(F.sum("n").alias("total"))
    scores = parts.join(totals, "user_id").select(
        "user_id", F.col("event_type").alias("label"), F.ascii("event_type").alias("ord"), (F.col("n") / F.col("total")).alias("score")
    )
    return matching.label_top1(scores, LABEL_SHARE, "user_id")


@on_notes
def cascade_diagnoses(notes):
    return std.cascade(inputs.spans_of(notes), **CASCADE).drop("category", "value", "unit")


@query
def cascade_misspelt(spark, sf_dir):
    spans = inputs.misspelt_diagnoses(spark, sf_dir).select("record_id", F.lit(0).alias("ord"), F.col("term").alias("entity"))
    return std.cascade(spans, **CASCADE).select("record_id", "raw", "standard", "score", "method")


@on_notes
def fallback_label(notes):
    found = std.fallback_label(notes, "disease IS NULL")
    return found.select("record_id", "standard", "score", "method")


@query
def cascade_vectors(spark, sf_dir):
    """The cascade with vectors made elsewhere: those of ``embeddings`` against the means of their labels."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    named = vectors.select("vec_id", F.concat(F.lit("item "), F.col("vec_id").cast("string")).alias("term"), "embedding")
    spans = named.select(F.col("vec_id").alias("record_id"), F.lit(0).alias("ord"), F.col("term").alias("entity"))
    means = _label_vectors(vectors)
    out = std.cascade(
        spans,
        diagnoses=means.select("term", "ord"),
        semantic_threshold=VECTOR_THRESHOLD,
        term_vectors=named.select("term", F.col("embedding").alias("vector")),
        diagnosis_vectors=means,
    )
    return out.select("record_id", "raw", "standard", "score", "method")


@query
def cascade_dictionary(spark, sf_dir):
    """The cascade twice with one folder of matches: the second run finds every term in it."""
    spans = inputs.misspelt_diagnoses(spark, sf_dir).select("record_id", F.lit(0).alias("ord"), F.col("term").alias("entity"))
    folder = fresh_folder(spark, "matches")
    dictionary.matched_terms(std.term_counts(spans), folder, **CASCADE)
    return dictionary.cascade_with_dictionary(spans, folder, **CASCADE).select("record_id", "raw", "standard", "score", "method")


def _disease_labels(notes: DataFrame) -> DataFrame:
    """Scores of all notes without a disease, by what notes with one have in common."""
    known = notes.filter("disease IS NOT NULL")
    of = known.select("record_id", F.col("disease").alias("label"), F.ascii("disease").alias("ord"))
    weights, _ = labels.learnt_labels(known, of)
    # learnt once: the texts are not taken apart again for each use
    spark, folder = notes.sparkSession, fresh_folder(notes.sparkSession, "labels")
    weights.write.parquet(f"{folder}/weights")
    _, learnt = labels.learnt_labels(known, of, weights=spark.read.parquet(f"{folder}/weights"))
    learnt.write.parquet(f"{folder}/centroids")
    weights, learnt = (spark.read.parquet(f"{folder}/{name}") for name in ("weights", "centroids"))
    return labels.scored_notes(notes.filter("disease IS NULL"), weights, learnt)


@on_notes
def label_centroid_scores(notes):
    return _disease_labels(notes).select("record_id", "label", "score")


@on_notes
def fallback_centroids(notes):
    """The best of these scores as the label of each note."""
    found = std.fallback_label(notes, "disease IS NULL", scores=_disease_labels(notes), threshold=0.05)
    return found.select("record_id", "standard", "score", "method")


@query
def semantic_match_parts(spark, sf_dir):
    """Vectors of misspelt part names against those of a table of names."""
    terms = inputs.misspelt_parts(spark, sf_dir).groupBy("term").agg(F.count("*").alias("n"))
    names = inputs.table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("ord"))
    rows = std.encoded_terms(terms.withColumn("ord", F.col("n"))).select("term", F.col("ord").alias("n"), "vector")
    return matching.vector_join(rows, std.encoded_terms(names), PART_THRESHOLD).drop("vector")


@on_notes
def standardised_long(notes):
    return std.standardise(notes, inputs.spans_of(notes), **CASCADE)


@on_notes
def standardise_fallback(notes):
    return std.standardise(notes, inputs.spans_of(notes), use_fallback=True, bare="disease IS NULL", **CASCADE)


@on_notes
def standardised_map_items(notes):
    """The items of each note's map, in their order."""
    maps = std.standardised_map(std.standardise(notes, inputs.spans_of(notes), **CASCADE), notes)
    lists = maps.select("record_id", F.explode("standardised").alias("pattern", "items"))
    items = lists.select("record_id", "pattern", F.posexplode_outer("items").alias("pos", "i"))
    fields = ("raw", "standard", "category", "value", "unit", "score", "method")
    return items.select("record_id", "pattern", "pos", *[F.col(f"i.{c}").alias(c) for c in fields])


@on_notes
def method_distribution(notes):
    return std.method_distribution(inputs.spans_of(notes), **CASCADE)


# --- de-identification -----------------------------------------------------------------------


def _pii(kind: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(deid.find_pii(inputs.notes(spark, sf_dir), {kind: IDENTIFIER_PATTERNS[kind]}).select("record_id", "text", "start", "end"))

    _QUERIES[name] = run


PII_QUERIES = {
    "PHONE": "pii_phone",
    "EMAIL": "pii_email",
    "POSTCODE": "pii_postcode",
    "MICROCHIP": "pii_microchip",
    "DATE": "pii_date",
    "ID": "pii_registration_id",
}
for _kind, _name in PII_QUERIES.items():
    _pii(_kind, _name)


@query
def pii_email_documents(spark, sf_dir):
    documents = inputs.spread(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return deid.find_pii(documents, {"EMAIL": IDENTIFIER_PATTERNS["EMAIL"]}, "text", "doc_id").select("doc_id", "text", "start", "end")


@query
def pii_conversations(spark, sf_dir):
    """Identifiers of every type in whole conversation turns, to some of which a line of contact is added."""
    turns = inputs.table(spark, sf_dir, "conversations")
    contact = F.expr("""CASE conv_id % 3 WHEN 0 THEN concat(' Mail user.', cast(conv_id AS string), '@example.org, M1 1AA')
      WHEN 1 THEN concat(' on 01/0', cast(turn % 9 + 1 AS string), '/2024') ELSE '' END""")
    keyed = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), F.concat("text", contact).alias("text"))
    return deid.find_pii(inputs.spread(keyed, "turn_id"), None, "text", "turn_id")


@query
def pii_documents(spark, sf_dir):
    """Identifiers of every type in whole documents."""
    documents = inputs.spread(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return deid.find_pii(documents, None, "text", "doc_id")


@on_notes
def pii_spans(notes):
    return deid.find_pii(notes)


@on_notes
def pii_counts(notes):
    return deid.pii_counts(deid.find_pii(notes))


@on_notes
def pii_placeholders(notes):
    return deid.entities_long(deid.redact_structured(notes)).drop("frame")


@on_notes
def redact_structured(notes):
    return deid.redact_structured(notes).select("record_id", "redacted_text")


@on_notes
def filter_spans_smart(notes):
    return ent.filter_spans_smart(inputs.given_spans(notes))


@on_notes
def redact_entities(notes):
    done = deid.redact_entities(notes)
    return done.select("record_id", "redacted_text", F.size("entities").alias("n_entities"))


@on_notes
def deidentify_notes(notes):
    done = deid.deidentify(notes)
    return done.select("record_id", "redacted_text", F.size("entities").alias("n_entities"), "n_structured")


@on_notes
def entities_all(notes):
    return deid.entities_long(deid.deidentify(notes), n_structured="n_structured")


@query
def deidentify_gazetteer(spark, sf_dir):
    done = deid.deidentify(inputs.named_notes(spark, sf_dir), inputs.gazetteer(spark, sf_dir))
    return done.select("record_id", "redacted_text", F.size("entities").alias("n_entities"))


@on_notes
def publish_notes(notes):
    """What is published of each note: no span text of an unmatched diagnosis among it."""
    maps = std.standardised_map(std.standardise(notes, inputs.spans_of(notes), **CASCADE), notes)
    done = deid.deidentify(ext.extract_all(notes)).select(
        "record_id", "extracted", F.struct("redacted_text", F.col("entities").alias("entities_found")).alias("deidentified")
    )
    records = quality.attach_scores(done.join(maps, "record_id"), quality.quality_scores(inputs.annotated(notes), _items(notes), weight="n"))
    public = publish(records)
    diagnoses = F.element_at("standardised", F.lit("diagnoses"))
    return public.select(
        "record_id",
        "redacted_text",
        F.array_join(F.transform("entities", lambda e: e["placeholder"]), "|").alias("placeholders"),
        F.aggregate(F.map_values("patterns"), F.lit(0), lambda n, m: n + F.size(m)).alias("n_matches"),
        F.get(diagnoses, F.lit(0))["standard"].alias("diagnosis"),
        F.get(diagnoses, F.lit(0))["method"].alias("method"),
        F.element_at("quality_scores", F.lit("Accuracy"))["after"].alias("accuracy"),
    )


# --- privacy ---------------------------------------------------------------------------------


@on_notes
def quasi_keys(notes):
    return privacy.quasi_keys(notes)


@on_notes
def k_groups(notes):
    return privacy.k_groups(privacy.quasi_keys(notes))


@on_notes
def k_risky_groups(notes):
    return privacy.k_anonymity(privacy.k_groups(privacy.quasi_keys(notes))).filter("risky").drop("risky")


@on_notes
def k_members(notes):
    return privacy.k_members(privacy.quasi_keys(notes))


@on_notes
def k_summary(notes):
    return privacy.k_summary(privacy.k_groups(privacy.quasi_keys(notes)))


@on_notes
def generalise_age(notes):
    ages = privacy.quasi_keys(notes).groupBy("age").agg(F.count("*").alias("n"))
    return ages.select("age", privacy.generalise_age("age").alias("age_band"), "n")


@on_notes
def generalise_weight(notes):
    weights = privacy.quasi_keys(notes).groupBy("weight").agg(F.count("*").alias("n"))
    return weights.select("weight", privacy.generalise_weight("weight").alias("weight_band"), "n")


@on_notes
def k_mitigated(notes):
    lists = privacy.mitigated_patterns(notes)
    return lists.select(
        "record_id", F.array_join("age_values", "|").alias("age_values"), F.array_join("weight_values", "|").alias("weight_values"),
        "sex", "n_records", "risky",
    )


@on_notes
def k_before_after(notes):
    return privacy.k_before_after(privacy.quasi_keys(notes))


@query
def k_customers(spark, sf_dir):
    """Another table, other keys and another rule."""
    customers = inputs.table(spark, sf_dir, "customer")
    nations = inputs.table(spark, sf_dir, "nation")
    keyed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.floor(F.col("c_acctbal") / 1000).cast("string").alias("balance"),
    )
    return privacy.k_before_after(keyed, 5, CUSTOMER_KEYS, CUSTOMER_RULES)


# --- evaluation ------------------------------------------------------------------------------


def _eval_counts(notes: DataFrame) -> DataFrame:
    found = deid.deidentify(inputs.annotated(notes).select("record_id", "raw_text", "gold"))
    pairs = found.select("record_id", "gold", F.col("entities.text").alias("found"))
    return evaluation.span_counts(pairs, "gold", "found")


@on_notes
def deid_eval_counts(notes):
    return _eval_counts(notes)


@on_notes
def deid_eval_scores(notes):
    return evaluation.evaluate_spans(_eval_counts(notes))


# --- quality ---------------------------------------------------------------------------------


def _dimension(checks: DataFrame, name: str) -> DataFrame:
    return quality.scores(checks.filter(F.col("dimension") == name))


def _items(notes: DataFrame) -> DataFrame:
    return std.item_counts(notes, inputs.spans_of(notes), **CASCADE)


@on_notes
def quality_completeness(notes):
    return _dimension(quality.note_checks(inputs.annotated(notes)), "Completeness")


@on_notes
def quality_accuracy_raw(notes):
    """Once with the shipped canonical terms and once with the abbreviations themselves."""
    checks = quality.note_checks(inputs.annotated(notes))
    known = quality.note_checks(inputs.annotated(notes), ["BAR", "NAD", "CRT", "BP"])
    shipped = _dimension(checks, "Accuracy").select(F.lit("canonical").alias("terms"), "before")
    return shipped.unionByName(_dimension(known, "Accuracy").select(F.lit("abbreviations").alias("terms"), "before"))


@on_notes
def quality_accuracy(notes):
    return _dimension(quality.item_checks(_items(notes), "n"), "Accuracy").select("dimension", "after")


@on_notes
def quality_consistency(notes):
    return _dimension(quality.item_checks(std.standardise_patterns(ext.extract_patterns(notes))), "Consistency")


@on_notes
def quality_validity(notes):
    items = std.standardise_patterns(ext.extract_patterns(notes))
    checks = quality.note_checks(inputs.annotated(notes)).unionByName(quality.item_checks(items))
    return _dimension(checks, "Validity")


@on_notes
def quality_uniqueness(notes):
    return _dimension(quality.uniqueness_checks(notes, ["raw_text"]), "Uniqueness")


@query
def quality_uniqueness_documents(spark, sf_dir):
    return _dimension(quality.uniqueness_checks(inputs.table(spark, sf_dir, "documents"), ["text"]), "Uniqueness")


@query
def quality_uniqueness_sketches(spark, sf_dir):
    """Sketches by source of the documents, merged: rows, and whether the count of distinct texts is as near as it should be."""
    documents = inputs.table(spark, sf_dir, "documents")
    merged = quality.approximate_uniqueness(quality.merged_sketches(quality.distinct_sketches(documents, ["text"], ["source"])))
    exact = documents.agg((F.countDistinct("text") + F.max(F.when(F.col("text").isNull(), 1).otherwise(0))).alias("exact"))
    near = F.abs(F.col("distinct_keys") - F.lit(exact.scalar())) <= F.col("error") * F.lit(exact.scalar())
    return merged.select("n", F.lit(exact.scalar()).cast("bigint").alias("distinct_texts"), near.alias("near"))


@on_notes
def quality_no_notes(notes):
    """The report on a table that has no rows."""
    none = notes.filter("record_id < 0")
    return quality.quality_report(quality.quality_scores(inputs.annotated(none), _items(none), weight="n"))


@on_notes
def quality_standardisation(notes):
    return _dimension(quality.item_checks(_items(notes), "n"), "Standardisation")


@on_notes
def quality_report(notes):
    return quality.quality_report(quality.quality_scores(inputs.annotated(notes), _items(notes), weight="n"))


@on_notes
def attach_scores(notes):
    six = quality.quality_scores(inputs.annotated(notes), _items(notes), weight="n")
    scored = quality.attach_scores(notes.select("record_id"), six)
    flat = [
        F.element_at("quality_scores", F.lit(d))[side].alias(f"{d.lower()}_{side}")
        for d in quality.DIMENSIONS
        for side in ("before", "after")
    ]
    return scored.select("record_id", *flat)


_QUERIES["parse_annotations"] = _QUERIES.pop("parse_annotations_rows")
_QUERIES["shape_records"] = _QUERIES.pop("shape_records_rows")


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Methods by which the matches of each pattern were standardised."""
    items = std.standardise_patterns(ext.extract_patterns(inputs.notes(spark, sf_dir)))
    return items.groupBy("pattern", "method").agg(F.count("*").alias("n")).orderBy("pattern", "method")


_QUERIES["pattern_methods"] = flagship
