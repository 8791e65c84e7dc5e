import pytest
from pyspark.sql import functions as F

from noteloom.operators import privacy, quality
from noteloom.operators.extract import extract_patterns
from noteloom.operators.standardise import standardise, standardise_patterns
from noteloom.plans import inputs


@pytest.mark.parametrize(
    "age,band",
    [("6 mo", "6-10 years"), ("8wk", "juvenile"), ("4 years", "3-5 years"), ("juvenile", "unknown"), ("2yo", "0-2 years"), ("6 Months", "juvenile"),
     ("11 yr", "11+ years"), ("99999999999999999999999 yo", "11+ years"), ("٣ yo", "3-5 years"), ("unknown", "unknown")],
)
def test_age_bands(spark, age, band):
    assert spark.createDataFrame([(age,)], "a string").select(privacy.generalise_age("a")).first()[0] == band


@pytest.mark.parametrize("weight,band", [("32kg", "20-40kg"), ("900 g", "40+kg"), ("5kg", "5-10kg"), ("4.99 kg", "0-5kg"), ("40 kg", "40+kg"), ("10. kg", "10-20kg"), ("none", "unknown")])
def test_weight_bands(spark, weight, band):
    assert spark.createDataFrame([(weight,)], "w string").select(privacy.generalise_weight("w")).first()[0] == band


def test_only_risky_records_change(texts):
    rows = texts(*["4yo 3kg MN"] * 5, "7yo 12kg then 13kg FS", "dog")
    got = {r.record_id: (r.age_values, r.weight_values, r.sex, r.n_records) for r in privacy.mitigated_patterns(rows).collect()}
    assert got[0] == (["4yo"], ["3kg"], "MN", 5)
    assert got[5] == (["6-10 years"], ["10-20kg"], "FS", 1)
    assert got[6] == ([], [], "unknown", 1)


def test_group_table_after_mitigation_equals_records_after_mitigation(notes):
    keyed = privacy.quasi_keys(notes)
    from_groups = privacy.mitigated_groups(privacy.k_groups(keyed))
    from_records = privacy.k_groups(privacy.mitigate(keyed).select("record_id", *privacy.QUASI_KEYS))
    assert from_groups.exceptAll(from_records).count() == 0 == from_records.exceptAll(from_groups).count()
    before, after = privacy.k_groups(keyed), from_groups
    assert before.agg(F.sum("n_records")).first()[0] == after.agg(F.sum("n_records")).first()[0] == notes.count()
    assert after.count() <= before.count()


def test_hot_combination_keeps_every_record(spark):
    keyed = spark.range(20000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 > 0, "unknown").otherwise(F.col("id").cast("string")).alias("age"), F.lit("u").alias("weight"), F.lit("u").alias("sex"))
    members = privacy.k_members(keyed)
    assert members.count() == 20000 and members.filter("risky").count() == 6667


def test_known_group_numbers(spark):
    rows = privacy.k_summary(privacy.k_groups(privacy.quasi_keys(inputs.notes(spark, "/root/testdata/sf0.01")))).first()
    assert (rows.n_groups, rows.risky_groups, rows.records_at_risk, rows.n_records) == (1546, 1123, 2479, 10000)


def annotated(spark, *rows):
    return spark.createDataFrame(rows, "record_id long, raw_text string, icd_labels array<string>, disease_spans array<string>")


def scores_of(notes, items):
    return {r.dimension: (r.before, r.after) for r in quality.quality_scores(notes, items).collect()}


def no_items(spark):
    return standardise_patterns(extract_patterns(spark.createDataFrame([], "record_id long, raw_text string")))


def test_empty_input(spark):
    got = scores_of(annotated(spark), no_items(spark))
    assert got == {d: (0.5, 0.5) if d == "Consistency" else (0.0, 0.0) for d in quality.DIMENSIONS}


def test_null_text_is_incomplete_and_invalid(spark):
    got = scores_of(annotated(spark, (1, None, [], None), (2, "BAR and well", ["x"], ["y"])), no_items(spark))
    assert got["Completeness"] == (0.5, 0.75) and got["Validity"] == (0.5, 0.5) and got["Uniqueness"] == (1.0, 1.0)


def test_ranges_and_units(texts):
    items = standardise_patterns(extract_patterns(texts("0.05kg 50 kg 500 g 0yo 30yo 31yo T=34.9 T=42.0")))
    got = {r.dimension: r.after for r in quality.scores(quality.item_checks(items)).collect()}
    assert got["Consistency"] == pytest.approx(3 / 8) and got["Validity"] == 1.0


def test_uniqueness_counts_null_once(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("",)], "t string")
    got = quality.scores(quality.uniqueness_checks(rows, ["t"])).first()
    # NULL and the empty text are two values
    assert got.before == pytest.approx(3 / 5)


def test_accuracy_equals_standardisation(notes):
    items = standardise(notes, inputs.spans_of(notes))
    got = {r.dimension: r.after for r in quality.scores(quality.item_checks(items)).collect()}
    assert got["Accuracy"] == pytest.approx(got["Standardisation"])


def test_report_has_mean_and_scores_are_attached(spark, notes):
    six = quality.quality_scores(inputs.annotated(notes), standardise(notes, inputs.spans_of(notes)))
    report = {r.dimension: r for r in quality.quality_report(six).collect()}
    assert len(report) == 7
    assert report["OVERALL"].after == pytest.approx(sum(report[d].after for d in quality.DIMENSIONS) / 6)
    scored = quality.attach_scores(notes.select("record_id"), six)
    assert scored.count() == notes.count() and set(scored.first().quality_scores) == set(quality.DIMENSIONS)
