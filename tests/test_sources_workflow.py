import json

import pytest
from pyspark.sql import functions as F

from noteloom.operators.privacy import quasi_keys
from noteloom.operators.quality import quality_scores
from noteloom.operators.standardise import standardise
from noteloom.plans import inputs
from noteloom.plans.workflow import Run, final_records, run_all
from noteloom.sources.annotations import parse_labels, parse_spans
from noteloom.sources.notes import disease_spans, label_arrays, read_notes, read_records, write_records
from noteloom.streaming.notes import redacted_stream, standardised_stream, stream_notes, write_stream


@pytest.mark.parametrize(
    "text,entities",
    [
        ("[{'entity': 'Bob'}", ["Bob"]),
        ("[{'entity': 'Bo", []),
        ("abc", []),
        ("", []),
        ("[]", []),
        (None, []),
        ("""[{'entity': "O'Brien", 'label': True}, {'entity': 'a\\xe9b', 'start': None},]""", ["O'Brien", "aéb"]),
        ("[{'entity': 'None, True [x]'}, {'entity': 'it\\'s \"so\"'}]", ["None, True [x]", "it's \"so\""]),
        ("[{'entity': 'Bob'}, {'ent", []),
        ("[{'entity': 'a\\nb'}]", ["a\nb"]),
    ],
)
def test_parse_spans(spark, text, entities):
    row = spark.createDataFrame([(text,)], "t string").select(parse_spans("t").alias("s")).first()
    assert [s.entity for s in row.s] == entities


def test_parse_labels(spark):
    rows = spark.createDataFrame([("['a', \"b's\"]",), ("['a'",), ("x",)], "t string").select(parse_labels("t").alias("l")).collect()
    assert [r.l for r in rows] == [["a", "b's"], ["a"], []]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_sources_read_the_same(spark, sf_dir, tmp_path, fmt):
    rows = inputs.source_rows(spark, sf_dir)
    path = str(tmp_path / fmt)
    options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    rows.write.options(**options).format(fmt).save(path)
    read = read_notes(spark, path, fmt)
    counts = read.agg(F.count("*"), F.sum(F.size("ground_truth.disease_spans")), F.sum(F.size("ground_truth.icd_labels")), F.sum(F.length("raw_text"))).first()
    expected = read_notes_from(rows).agg(F.count("*"), F.sum(F.size("ground_truth.disease_spans")), F.sum(F.size("ground_truth.icd_labels")), F.sum(F.length("raw_text"))).first()
    assert counts == expected and counts[0] == 1000


def read_notes_from(rows):
    from noteloom.sources.annotations import parse_annotations
    from noteloom.sources.notes import shape_records

    return shape_records(parse_annotations(rows))


def test_json_array_file(spark, tmp_path):
    record = {
        "record_id": 1, "raw_text": "BAR", "ground_truth": {"icd_labels": ["x"], "anon_spans": [], "disease_spans": [{"entity": "OA"}]},
        "extracted": {"vet_patterns": {"clinical_status": ["BAR"]}}, "standardised": {}, "deidentified": {}, "quality_scores": {},
    }
    path = tmp_path / "records.json"
    path.write_text(json.dumps([record, {**record, "record_id": 2}], indent=2))
    rows = read_records(spark, str(path), "json", multi_line=True)
    assert [r.record_id for r in rows.orderBy("record_id").collect()] == [1, 2]
    assert rows.first().extracted.vet_patterns == {"clinical_status": ["BAR"]}
    write_records(rows, str(tmp_path / "lines"), "json")
    assert read_records(spark, str(tmp_path / "lines"), "json").count() == 2


def test_long_literals_do_not_overflow(spark):
    long = "it\\'s x " * 150_000
    rows = spark.createDataFrame([(f"[{{'entity': '{long}', 'label': None}}]",), ("[{'entity': '" + "y" * 1_000_000,)], "t string")
    got = rows.select(parse_spans("t").alias("s")).collect()
    assert got[0].s[0].entity == long.replace("\\", "") and got[1].s == []


@pytest.fixture(scope="module")
def finished(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    inputs.source_rows(spark, sf_dir).write.parquet(str(folder / "source"))
    run = Run(spark, str(folder / "out"), match_options={"semantic_threshold": 0.5})
    return run, run_all(run, str(folder / "source"))


def written_at(run, stage):
    rows = run.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(run.path(stage)).select("path", "modificationTime")
    return sorted(map(tuple, rows.collect()))


def test_a_broken_run_goes_on(spark, sf_dir, tmp_path):
    """Buckets, resuming and kept matches; the result is that of a plain run."""
    inputs.source_rows(spark, sf_dir).write.parquet(str(tmp_path / "source"))
    options = {"match_options": {"semantic_threshold": 0.5}, "resume": True, "buckets": 4, "match_folder": str(tmp_path / "matches")}
    run = Run(spark, str(tmp_path / "out"), **options)
    report = sorted(map(tuple, run_all(run, str(tmp_path / "source")).collect()))
    stages = ["records", "texts", "standardised", "mitigated", "quality", "final", "public"]
    before = {s: written_at(run, s) for s in stages}

    plan = final_records(run)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    moved = [i for i, line in enumerate(plan) if "Exchange hash" in line]
    assert moved and any("raw_text" in line for line in plan)
    for i in moved:
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        assert not any("raw_text" in line for line in plan[i:below]), plan[i]

    # the run stopped while a stage was written: its mark is gone
    run.stages._set_mark("quality", "")
    again = Run(spark, str(tmp_path / "out"), **options)
    assert sorted(map(tuple, run_all(again, str(tmp_path / "source")).collect())) == report
    after = {s: written_at(again, s) for s in stages}
    assert {s for s in stages if before[s] != after[s]} == {"quality"}

    # another option: what depends on it is made anew
    other = Run(spark, str(tmp_path / "out"), **{**options, "k": 3})
    run_all(other, str(tmp_path / "source"))
    assert written_at(other, "records") == before["records"] and written_at(other, "mitigated") != before["mitigated"]

    plain = Run(spark, str(tmp_path / "plain"), k=3, match_options={"semantic_threshold": 0.5})
    run_all(plain, str(tmp_path / "source"))
    for stage in ("records", "standardised", "quality", "public"):
        one, two = (r.load(stage) for r in (other, plain))
        text = [F.to_json(F.struct(*sorted(one.columns))).alias("j")]
        assert one.count() == two.count() and one.select(*text).exceptAll(two.select(*text)).count() == 0, stage
    # known to a session that did not write it
    spark.sql(f"DROP TABLE {other.stages._name('texts')}")
    assert other.load("texts").count() == plain.load("texts").count()


def test_quality_from_kept_facts(finished):
    run, _ = finished
    notes = label_arrays(run.load("records"))
    plain = quality_scores(notes, run.load("standardised"))
    assert sorted(map(str, run.load("quality").collect())) == sorted(map(str, plain.collect()))


def test_whole_run(finished):
    run, report = finished
    assert report.count() == 7
    final = run.load("final")
    assert final.count() == 1000
    row = final.filter("record_id % 9 = 7").first()
    assert "Hale" in row.raw_text and "[PERSON_1]" in row.deidentified.redacted_text
    assert "diagnoses" in row.standardised and set(row.quality_scores) >= {"Accuracy", "Validity"}
    risk = {r.stage: r for r in run.load("privacy_risk").collect()}
    assert risk["after"].records_at_risk < risk["before"].records_at_risk and risk["after"].n_records == 1000
    assert 0 < run.load("evaluation").first().f1 < 1


def test_published_table_holds_no_identifiers(finished):
    run, _ = finished
    public, final = run.load("public"), run.load("final")
    assert set(public.columns) == {"record_id", "redacted_text", "entities", "patterns", "standardised", "quality_scores"}
    everything = public.select("record_id", F.to_json(F.struct("*")).alias("j"))
    found = final.select("record_id", F.explode("deidentified.entities_found.text").alias("t"))
    assert everything.join(found, "record_id").filter(F.col("j").contains(F.col("t"))).count() == 0
    risky = run.load("mitigated").filter("risky").select("record_id")
    raw = quasi_keys(final).join(risky, "record_id").filter("age <> 'unknown'")
    kept = public.select("record_id", F.element_at("patterns", F.lit("age")).alias("shown"))
    assert raw.join(kept, "record_id").filter(F.array_contains("shown", F.col("age"))).count() == 0


def test_published_table_holds_no_unmatched_span_text(finished):
    run, _ = finished
    public = run.load("public")
    shown = public.select("record_id", F.explode(F.element_at("standardised", F.lit("diagnoses"))).alias("i"))
    assert shown.filter("i.method = 'unmatched' AND i.standard IS NOT NULL").count() == 0
    assert shown.filter("i.method = 'unmatched'").count() > 0 and shown.filter("i.standard IS NOT NULL").count() > 0
    texts = run.load("standardised").filter("pattern = 'diagnoses' AND method = 'unmatched'").select("record_id", "raw")
    everything = public.drop("redacted_text").select("record_id", F.to_json(F.struct("*")).alias("j"))
    assert everything.join(texts, "record_id").filter(F.col("j").contains(F.col("raw"))).count() == 0
    families = {r.k for r in public.select(F.explode(F.map_keys("patterns")).alias("k")).distinct().collect()}
    assert families >= {"vital_sign", "temperature", "dosage", "age", "weight", "sex_neuter", "clinical_status"}


def test_fallback_stage_of_records(finished):
    run, _ = finished
    records = run.load("records")
    items = standardise(records, disease_spans(records), use_fallback=True, semantic_threshold=0.5)
    labelled = items.filter("method = 'zero_shot'").select("record_id")
    assert labelled.count() > 0
    assert labelled.join(records.filter("size(ground_truth.disease_spans) > 0"), "record_id").count() == 0


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    notes = inputs.notes(spark, sf_dir).select("record_id", "raw_text")
    notes.repartition(3).write.parquet(str(tmp_path / "in"))
    for name, transform in (("items", standardised_stream), ("redacted", redacted_stream)):
        out, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        write_stream(transform(stream_notes(spark, str(tmp_path / "in"))), out, state).awaitTermination()
        batch, stream = transform(notes), spark.read.parquet(out)
        assert batch.count() == stream.count() and batch.exceptAll(stream.select(*batch.columns)).count() == 0


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    """Rows as narrow as events get more tasks as they grow, and all of them arrive."""
    monkeypatch.setattr(inputs, "TASK_ROWS", 1000)
    rows = spark.range(0, 64_500, 1, 8)
    spread = inputs.spread(rows, "id")
    assert spread.rdd.getNumPartitions() == 65 and spread.distinct().count() == 64_500
    assert inputs.spread(spark.range(0, 500, 1, 8), "id").rdd.getNumPartitions() == 8
