"""The whole run over annotated notes, stage by stage.

Each stage is a table, so a later one starts from written data instead of recomputing (an
executor that is lost costs the tasks of one stage), and every stage can be read on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.operators.deidentify import deidentify
from noteloom.operators.evaluation import evaluate_spans, span_counts
from noteloom.operators.extract import extract_all, extracted_patterns
from noteloom.operators.privacy import extracted_lists, k_before_after, mitigated_lists
from noteloom.operators.publish import publish
from noteloom.operators.quality import attach_scores, fact_checks, item_checks, quality_report, scores, with_note_facts
from noteloom.operators.standardise import method_distribution, standardise, standardised_map
from noteloom.sources.notes import disease_spans, read_notes
from noteloom.sources.stages import Stages, source_mark, table_digest


@dataclass
class Run:
    """Where the stages of a run live, and the options of its operators.

    With ``resume`` a run goes on where one over the same source and options stopped.  ``buckets`` lays the tables out by record
    (:mod:`noteloom.sources.stages`); ``match_folder`` keeps matched terms between runs (:mod:`noteloom.operators.dictionary`).
    """

    spark: SparkSession
    folder: str
    fmt: str = "parquet"
    k: int = 5
    use_fallback: bool = False
    gazetteer: dict | DataFrame | None = None
    match_options: dict = field(default_factory=dict)
    resume: bool = False
    buckets: int | None = None
    match_folder: str | None = None

    def __post_init__(self) -> None:
        self.stages = Stages(self.spark, self.folder, self.fmt, self.buckets)

    def path(self, stage: str) -> str:
        return self.stages.path(stage)

    def save(self, table: DataFrame, stage: str, *inputs: str, options: str = "", deal: bool = False) -> DataFrame:
        return self.stages.save(table, stage, inputs, options, self.resume, deal)

    def load(self, stage: str) -> DataFrame:
        return self.stages.load(stage)

    def options(self) -> str:
        """What the stages on texts and terms depend on beside their input; tables count by their rows."""
        given = {k: table_digest(v) if isinstance(v, DataFrame) else v for k, v in {"gazetteer": self.gazetteer, **self.match_options}.items()}
        return repr((self.k, self.use_fallback, sorted((k, getattr(v, "__qualname__", repr(v))) for k, v in given.items())))


def load_stage(run: Run, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    made_from = repr((source_mark(run.spark, source), fmt, sorted(options.items())))
    return run.save(read_notes(run.spark, source, fmt, **options), "records", options=made_from, deal=True)


def text_stage(run: Run) -> DataFrame:
    """Records with ``extracted``, ``redacted_text``, ``entities`` and ``n_structured``, and what quality needs of each note.

    The one stage that looks into the notes: each text is matched here and nowhere else.
    """
    found = extract_all(run.load("records"), run.gazetteer)
    done = deidentify(found, run.gazetteer)
    return run.save(with_note_facts(done), "texts", "records", options=run.options())


def standardise_stage(run: Run) -> DataFrame:
    records = run.load("records")
    patterns = extracted_patterns(run.load("texts"))
    items = standardise(
        records, disease_spans(records), patterns, use_fallback=run.use_fallback, match_folder=run.match_folder, **run.match_options
    )
    return run.save(items, "standardised", "records", "texts", options=run.options())


def privacy_stage(run: Run) -> tuple[DataFrame, DataFrame]:
    """k-anonymity before and after, and the pattern lists of each note with risky values generalised."""
    keyed = extracted_lists(run.load("texts"))
    risk = run.save(k_before_after(keyed, run.k), "privacy_risk", "texts", options=run.options())
    return risk, run.save(mitigated_lists(keyed, run.k), "mitigated", "texts", options=run.options())


def evaluation_stage(run: Run) -> DataFrame:
    """Detected entities against the annotated ones, row by row."""
    pairs = run.load("texts").select(
        "record_id", F.col("ground_truth.anon_spans.entity").alias("gold"), F.col("entities.text").alias("found")
    )
    return run.save(evaluate_spans(span_counts(pairs.filter(F.size("gold") > 0), "gold", "found")), "evaluation", "texts")


def quality_stage(run: Run) -> DataFrame:
    """The scores from the facts kept with the texts and from the standardised items; no text is read again."""
    six = scores(fact_checks(run.load("texts").select("note_facts")).unionByName(item_checks(run.load("standardised"))))
    return run.save(six, "quality", "texts", "standardised")


def final_records(run: Run) -> DataFrame:
    """One nested record per note with everything the stages found."""
    texts = run.load("texts")
    mitigated = run.load("mitigated").select("record_id", "age_values", "weight_values")
    patterns = standardised_map(run.load("standardised"), texts)
    # the one table with texts meets two without any
    whole = texts.join(patterns, "record_id").join(mitigated, "record_id")
    lists = F.transform_values(
        "extracted.vet_patterns",
        lambda k, v: F.when(k == "age", F.col("age_values")).when(k == "weight", F.col("weight_values")).otherwise(v),
    )
    shaped = whole.select(
        "record_id", "raw_text", "ground_truth",
        F.struct(F.col("extracted.ner_entities").alias("ner_entities"), lists.alias("vet_patterns")).alias("extracted"),
        "standardised",
        F.struct("redacted_text", F.col("entities").alias("entities_found")).alias("deidentified"),
    )
    return attach_scores(shaped, run.load("quality"))


def run_all(run: Run, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All stages; returns the quality report.  The public table is written last."""
    load_stage(run, source, fmt, **options)
    text_stage(run)
    standardise_stage(run)
    privacy_stage(run)
    evaluation_stage(run)
    quality_stage(run)
    spans = disease_spans(run.load("records"))
    run.save(method_distribution(spans, **run.match_options), "methods", "records", options=run.options())
    made = ("texts", "standardised", "mitigated", "quality")
    final = run.save(final_records(run), "final", *made)
    run.save(publish(final), "public", "final")
    return quality_report(run.load("quality"))
