import re

import pytest
from pyspark.sql import functions as F

from noteloom.functions.patterns import CLINICAL_PATTERNS, IDENTIFIER_PATTERNS
from noteloom.functions.text import all_matches
from noteloom.operators import standardise as std
from noteloom.operators.extract import extract_all, extract_patterns
from noteloom.operators.standardise import parse_values, standardise_patterns, standardised_map, with_vital_value

MIXED = [
    "HR 80 rr=20 Crt:2 BP 120.5 T=39.1 T 40 T: 38.25",
    "12.5 KG, 3 lbs, 900g 5kgs 4.5 yo 4y.o. dog, 6 mo old, 8wks 10 weeks 2 yrs",
    "FS fn MIFE Bar nad BARH 15mg/kg BID 2 ml q12h 3IU sid 5 mcg",
    "é12kg 12kgé ñFS FSñ ¹4yo 4yo² ٣٤ kg ４５ kg 7 kg 8\x1ckg",
    "ſc 5 mg ſC, 10 Kg (kelvin) K9",
    "07123 456789é 07123 456789 é07123456789 x07123 456789 01234\x1f567890 MRCVS",
    "é.b@x.com éabc@x.com abc@x.comé a_b@x.co.uk M1 1AAé M1 1AA 1-Feb-24é 1.2.24 123456789012345é 123456 MRCVS",
    "HR 80 rr=20.  BP: 7. T=39.1.2 T 40. hrs HRR crt12.5.6 xHR 9 T1 t1.5 12.kg 12..kg 1.2.3kg 12 .5kg 007g 5kgs",
    "4yo 4 yoo 44  years 4y.o 4yo. 6mos 6months1 8 wk. 1yr2 3mg/kgBID 3mg/kg  q12h 3 mg q8 mcg 3mcgs 3ml sid.",
    "FSFN FS-FN FS_FN MIFE mife BARH bar. NADS adr/tpr",
    "",
]


@pytest.mark.parametrize("name,pattern,ignore", [(n, p, True) for n, p in CLINICAL_PATTERNS.items()] + [(n, p, False) for n, p in IDENTIFIER_PATTERNS.items()])
def test_matches_equal_python(texts, name, pattern, ignore):
    rows = texts(*MIXED).select("raw_text", F.expr(all_matches("raw_text", pattern, ignore)).alias("m")).collect()
    for row in rows:
        assert row.m == re.findall(pattern, row.raw_text, re.IGNORECASE if ignore else 0), row.raw_text


def test_null_text_has_no_matches(texts):
    assert extract_patterns(texts(None)).count() == 0


def items(texts, text):
    rows = standardise_patterns(extract_patterns(texts(text))).collect()
    return {(r.pattern, r.raw): (r.standard, r.value, r.unit, r.method) for r in rows}


@pytest.mark.parametrize(
    "text,key,expected",
    [
        ("4.5 yo", ("age", "5 yo"), (None, 5.0, "yo", "parsed")),
        ("4y.o. dog", ("age", "4y.o"), (None, 4.0, "unknown", "parsed")),
        ("2 yrs", ("age", "2 yrs"), (None, 2.0, "yr", "parsed")),
        ("6 mo", ("age", "6 mo"), (None, 6.0, "unknown", "parsed")),
        ("5.2 KG", ("weight", "5.2 KG"), (None, 5.2, "kg", "parsed")),
        ("Hr=100", ("vital_sign", "Hr=100"), ("Heart Rate", None, None, "exact_match")),
        ("BP 120", ("vital_sign", "BP 120"), (None, None, None, "unmatched")),
        ("BARH", ("clinical_status", "BARH"), (None, None, None, "unmatched")),
        ("qar", ("clinical_status", "qar"), ("Quiet Alert Responsive", None, None, "exact_match")),
        ("fn", ("sex_neuter", "fn"), (None, None, None, "unmatched")),
        ("T=39.1", ("temperature", "T=39.1"), (None, 39.1, "°C", "parsed")),
        ("15mg/kg BID", ("dosage", "15mg/kg BID"), (None, 15.0, "mg/kg", "parsed")),
        ("٣٤ kg", ("weight", "٣٤ kg"), (None, 34.0, "kg", "parsed")),
    ],
)
def test_golden_items(texts, text, key, expected):
    assert items(texts, text)[key] == expected


def test_vital_value_is_extra(texts):
    row = with_vital_value(standardise_patterns(extract_patterns(texts("Hr=100")))).first()
    assert (row.standard, row.value, row.vital_value) == ("Heart Rate", None, 100.0)


def test_no_number_is_unmatched(spark):
    row = parse_values(spark.createDataFrame([(1, "age", 0, "old")], "record_id long, pattern string, ord int, raw string")).first()
    assert (row.value, row.unit, row.method) == (None, None, "unmatched")


def test_absent_patterns_have_no_key(texts):
    row = extract_all(texts("BAR and bar")).first().extracted
    assert row.vet_patterns == {"clinical_status": ["BAR", "bar"]} and row.ner_entities == []


def test_result_does_not_depend_on_partitioning(notes):
    one = extract_patterns(notes.coalesce(1))
    many = extract_patterns(notes.repartition(13))
    assert one.exceptAll(many).count() == 0 == many.exceptAll(one).count()


def test_map_of_odd_notes(spark):
    """Lists are made before the one shuffle, and no join sorts them again; shared, missing and bare ids keep a row a note."""
    rows = [(1, "weight", 1, "b"), (1, "weight", 0, "a"), (1, "age", 0, "c"), (2, "diagnoses", 0, "d"), (7, "age", 0, "lost"), (None, "age", 0, "lost")]
    shape = "record_id long, pattern string, ord int, raw string"
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("standard", "string"), ("category", "string"), ("value", "double"), ("unit", "string"), ("score", "double"))]
    items = spark.createDataFrame(rows, shape).select("*", *blank, F.lit("unmatched").alias("method"))
    notes = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,), (None,)], "record_id int")
    maps = standardised_map(items, notes)
    assert maps.schema["record_id"].dataType.simpleString() == "int"
    found = [(r.record_id, {p: [(i.ord, i.raw) for i in own] for p, own in r.standardised.items()}) for r in maps.collect()]
    one, two, none = {"weight": [(0, "a"), (1, "b")], "age": [(0, "c")], "diagnoses": []}, {"diagnoses": [(0, "d")]}, {"diagnoses": []}
    assert sorted(found, key=str) == sorted([(1, one), (2, two), (2, two), (3, none), (None, none), (None, none)], key=str)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, -1)
    try:
        plan = standardised_map(items, notes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert plan.index("functions=[collect_list") < plan.index("Exchange") < plan.index("partial_collect_list")


def test_map_of_many_notes_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(std, "COPIES", 3)
    notes = spark.createDataFrame([(5,)] * 8, "record_id long")
    items = std.standardise_patterns(spark.createDataFrame([(5, "weight", 0, "4kg")], "record_id long, pattern string, ord int, raw string"))
    assert [r.standardised["weight"][0].value for r in standardised_map(items, notes).collect()] == [4.0] * 8
