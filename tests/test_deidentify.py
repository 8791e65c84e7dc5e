import random
import re

import pytest
from pyspark.sql import functions as F

from noteloom.functions.patterns import IDENTIFIER_PATTERNS
from noteloom.operators.deidentify import deidentify, entities_long, find_pii, redact_entities, redact_structured
from noteloom.operators.entities import filter_entity_spans, filter_spans_smart, gazetteer_spans, tag_entities
from noteloom.operators.evaluation import evaluate_spans, span_counts
from test_extract import MIXED


def redact(texts, text):
    return redact_structured(texts(text)).first().redacted_text


@pytest.mark.parametrize(
    "text,expected",
    [
        ("call 01234 567890 MRCVS", "call [PHONE_1] MRCVS"),
        ("on 01/02/2024, 3-Feb-25, 01/02/2024", "on [DATE_1], [DATE_2], [DATE_1]"),
        ("07123456789@x.com ok", "[EMAIL_1] ok"),
        ("jo.M11AA@x.uk end", "[EMAIL_1] end"),
        ("ring 01234 5678901 MRCVS now", "ring [PHONE_1] MRCVS now"),
        ("07123 456789 or 07123456789", "[PHONE_1] or [PHONE_2]"),
        ("1.2.2024 then M1 1AA then 07123 456789", "[DATE_1] then [POSTCODE_1] then [PHONE_1]"),
        ("", ""),
        ("nothing here", "nothing here"),
        ("7/1/24", "[DATE_1]"),
        (None, None),
    ],
)
def test_golden_redaction(texts, text, expected):
    assert redact(texts, text) == expected


def test_offsets_equal_python(texts, notes):
    rows = texts(*MIXED).unionByName(notes.select(F.col("record_id") + 1000, "raw_text").toDF("record_id", "raw_text"))
    got = {(r.record_id, r.type, r.start, r.end, r.text) for r in find_pii(rows).collect()}
    expected = {
        (r.record_id, kind, m.start(), m.end(), m.group())
        for r in rows.collect()
        for kind, pattern in IDENTIFIER_PATTERNS.items()
        for m in re.finditer(pattern, r.raw_text)
    }
    assert got == expected


def python_redaction(text):
    """Straightforward redaction for texts without overlapping matches."""
    names, counts, found = {}, {}, []
    for kind, pattern in IDENTIFIER_PATTERNS.items():
        for m in re.finditer(pattern, text):
            if m.group() not in names:
                counts[kind] = counts.get(kind, 0) + 1
                names[m.group()] = f"[{kind}_{counts[kind]}]"
            found.append((m.start(), m.end(), names[m.group()]))
    found.sort()
    if any(a[1] > b[0] for a, b in zip(found, found[1:])):
        return None
    out, pos = "", 0
    for start, end, name in found:
        out, pos = out + text[pos:start] + name, end
    return out + text[pos:]


def test_redaction_equals_python_without_overlap(notes):
    checked = 0
    for r in redact_structured(notes.select("record_id", "raw_text")).collect():
        expected = python_redaction(r.raw_text)
        if expected is not None:
            checked += 1
            assert r.redacted_text == expected
    assert checked > 800


def test_many_matches_in_one_long_text(texts):
    text = " x ".join(f"{i % 28 + 1}/{i % 12 + 1}/20{i % 90 + 10}" for i in range(3000))
    assert redact(texts, text) == python_redaction(text)


def test_redacting_twice_changes_nothing_and_leaves_no_match(notes):
    once = redact_structured(notes.select("record_id", "raw_text")).select("record_id", F.col("redacted_text").alias("raw_text"))
    assert find_pii(once).count() == 0
    assert redact_structured(once).filter("redacted_text <> raw_text").count() == 0


def test_placeholders_restore_the_text(notes):
    for r in redact_structured(notes.select("record_id", "raw_text")).collect():
        text = r.redacted_text
        for e in r.entities:
            text = text.replace(e.placeholder, e.text)
        assert text == r.raw_text


def test_value_under_two_types_keeps_the_first(texts):
    patterns = {"A": r"\bx\d\b", "B": r"\bx\d\b(?=!)|\by\d\b"}
    # x1! matches both; merged spans take the first type, and so does the value elsewhere
    assert redact_structured(texts("x1! y1 x1 x2"), patterns).first().redacted_text == "[A_1]! [B_1] [A_1] [A_2]"


def test_placeholder_label_follows_the_value(texts):
    given = texts("Hale at Hale").withColumn(
        "spans",
        F.expr("array(named_struct('text','Hale','label','PERSON','start',0,'end',4), named_struct('text','Hale','label','GPE','start',8,'end',12))"),
    )
    row = redact_entities(given, spans="spans").first()
    assert row.redacted_text == "[PERSON_1] at [PERSON_1]" and [e.type for e in row.entities] == ["PERSON", "LOCATION"]


def test_entities_and_frames(texts):
    done = deidentify(texts("Ring 07123 456789 for Mrs Hale-Smith of Leeds, Leeds. PDSA and Blue Cross, 12 March 2024"))
    row = done.first()
    assert row.redacted_text == "Ring [PHONE_1] for Mrs [PERSON_1] of [LOCATION_1], [LOCATION_1]. PDSA and [ORG_1], 12 March 2024"
    frames = [(r.placeholder, r.frame) for r in entities_long(done, n_structured="n_structured").orderBy("ord").collect()]
    assert frames[0] == ("[PHONE_1]", "raw") and {f for _, f in frames[1:]} == {"regex_redacted"}


def test_placeholders_are_not_tagged(texts):
    assert tag_entities(texts("Mr [PERSON_1] in [LOCATION_1]")).count() == 0


def test_gazetteer_table_equals_pattern(spark, texts):
    rows = texts("From Leeds to Blue Cross York", "Leeds Leeds", "leeds", None)
    table = spark.createDataFrame([("Leeds", "GPE"), ("York", "GPE"), ("Blue Cross", "ORG")], "name string, label string")
    by_table = gazetteer_spans(rows, table)
    by_pattern = tag_entities(rows, {"GPE": ["Leeds", "York"], "ORG": ["Blue Cross"]})
    assert sorted(by_table.collect()) == sorted(by_pattern.collect()) and by_table.count() == 5


def test_gazetteer_table_of_any_size(spark, texts):
    rows = texts(
        "Sent to Royal Veterinary College of North London via [LOCATION_1] and Leeds", "North London Leeds's York_ éLeeds", "Mrs Leeds of College of North",
        "A B C D E F", None, "", "Call 01234 567890 for Mr Hale of Leeds, York or North London",
    )
    lists = {"GPE": ["Leeds", "York", "London", "C", "LOCATION_1"], "LOC": ["North London", "B C"], "ORG": ["Royal Veterinary College of North London", "A B", "College of North", "A B C D E F"]}
    lists = dict(sorted(lists.items()))
    small = spark.createDataFrame([(n, label) for label, names in lists.items() for n in names] + [(None, "GPE"), ("x", None), ("York", "GPE")], "name string, label string")
    large = small.unionByName(spark.range(3000).select(F.concat(F.lit("nobody "), "id").alias("name"), F.lit("ORG").alias("label")))
    expected = sorted(tag_entities(rows, lists).collect())
    assert sorted(tag_entities(rows, small).collect()) == sorted(tag_entities(rows, large).collect()) == expected
    assert sorted(tag_entities(rows, small.limit(0)).collect()) == sorted(tag_entities(rows, {}).collect())
    assert sorted(deidentify(rows, large).collect()) == sorted(deidentify(rows, lists).collect())
    many = {label: [*names, *(f"nobody {i}" for i in range(3000 if label == "ORG" else 0))] for label, names in lists.items()}
    assert sorted(tag_entities(rows, many).collect()) == expected


def test_gazetteer_names_of_any_shape(spark, texts):
    """Names may begin and end with any character; a word character beside them still rules them out."""
    rows = texts(
        "Acme Inc. and Acme Ltd of St. Mary (North), not xAcme Inc. nor Acme Inc.x", "(North) (North)s x(North) ((North))", "C++ C++x #1 a#1 C+", "St. Mary (North) St. Mary",
        "naïve Café-Bar’s, Café-Bar", "Acme  Inc. Acme\nInc.", "one two three four five six seven eight nine", "", None, "A.B.C. A.B.C", "Acme Inc.Acme Inc.", "é(North) 日(North) (North)é",
    )
    lists = {
        "GPE": ["St. Mary (North)", "(North)", "St. Mary"], "LOC": ["one two three four five six seven eight nine", "two three", "one two three four five"],
        "ORG": ["Acme Inc.", "Acme Ltd", "Acme", "C++", "#1", "Café-Bar", "A.B.C.", "A.B.", "Acme Inc.Acme"],
    }
    table = spark.createDataFrame([(n, label) for label, names in lists.items() for n in names] + [("", "ORG")], "name string, label string")
    expected = sorted(tag_entities(rows, lists).collect())
    assert len(expected) > 15
    assert sorted(tag_entities(rows, table).collect()) == expected
    assert sorted(deidentify(rows, table).collect()) == sorted(deidentify(rows, lists).collect())


def test_random_gazetteers(spark, texts):
    rng = random.Random(11)
    pieces = ["Ab", "Cd", "e", ".", "(", " ", "  ", "-", "é", "1", "\n", "'"]
    make = lambda n: "".join(rng.choices(pieces, k=rng.randint(1, n)))
    names = list(dict.fromkeys(make(5) for _ in range(40)))
    lists = {"GPE": names[:20], "ORG": names[20:]}
    rows = texts(*[make(40) for _ in range(150)])
    table = spark.createDataFrame([(n, label) for label, own in lists.items() for n in own], "name string, label string")
    assert sorted(tag_entities(rows, table).collect()) == sorted(tag_entities(rows, lists).collect())


def test_many_matches_take_time_in_proportion(texts):
    text = "x@y.com " * 100_000
    found = find_pii(texts(text, "a@b.org"), {"EMAIL": IDENTIFIER_PATTERNS["EMAIL"]}).filter("record_id = 0")
    got = found.agg(F.count("*"), F.min("start"), F.max("end"), F.countDistinct("start")).first()
    assert tuple(got) == (100_000, 0, len(text) - 1, 100_000)


def test_given_spans_after_structured_redaction(texts):
    rows = texts("Call 01234 567890 for Hale")
    named = redact_structured(rows).select("record_id", "raw_text", F.expr("array(named_struct('text', 'Hale', 'label', 'PERSON', 'start', 19, 'end', 23))").alias("model"))
    row = deidentify(named, spans="model").first()
    assert row.redacted_text == "Call [PHONE_1] for [PERSON_1]" and row.n_structured == 1


def test_long_names_do_not_overflow(texts):
    row = tag_entities(texts("Mr" + " Hale" * 100_000 + ". end")).first()
    assert (row.label, row.start, row.end) == ("PERSON", 3, 2 + 5 * 100_000)


def test_span_filters(spark):
    rows = [
        ("Hale", "PERSON"), (" BAR ", "ORG"), ("ABCDE", "ORG"), ("ABCDEF", "ORG"), ("X", "GPE"), ("Flat 4", "GPE"), ("Flat ²", "GPE"),
        ("hale", "PERSON"), ("hale", "GPE"), ("Monday", "DATE"), ("Leeds", "LOC"), ("bar", "ORG"), ("Metacam", "PERSON"),
    ]
    spans = spark.createDataFrame(rows, "text string, label string")
    assert {(r.text, r.type) for r in filter_spans_smart(spans).collect()} == {
        ("Hale", "PERSON"), ("ABCDEF", "ORG"), ("hale", "LOCATION"), ("Leeds", "LOCATION"),
    }
    assert ("Flat 4", "LOCATION") in {(r.text, r.type) for r in filter_spans_smart(spans, digits=False).collect()}
    kept = {r.text for r in filter_entity_spans(spans).collect()}
    assert "Monday" in kept and not kept & {" BAR ", "Metacam"} and "bar" in kept


def test_evaluation(spark):
    rows = [(1, ["Bob", "LEEDS", "bob"], ["bobby", "mon"]), (2, [], ["x"]), (3, ["a"], [])]
    counts = span_counts(spark.createDataFrame(rows, "record_id long, gold array<string>, found array<string>"), "gold", "found")
    assert {tuple(r) for r in counts.collect()} == {(1, 1, 1, 1), (3, 0, 1, 0)}
    row = evaluate_spans(counts).first()
    assert (row.tp, row.fn, row.fp) == (1, 2, 1) and row.precision == 0.5 and abs(row.recall - 1 / 3) < 1e-12
    empty = evaluate_spans(counts.filter("false")).first()
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)


def test_gazetteer_with_few_and_many_first_tokens(spark, texts, monkeypatch):
    """Names are the same whether their first tokens are looked for before the runs are made or by the join, and few make fewer runs."""
    from noteloom.operators import entities

    table = spark.createDataFrame([("Hale Clinic", "ORG"), ("Leeds", "LOC"), ("(North)", "LOC"), ("Hale", "ORG")], "name string, label string")
    rows = texts("Seen at Hale Clinic in Leeds (North), not xLeeds", "Hale", "", None)
    found = []
    for roots in (0, 256):
        monkeypatch.setattr(entities, "ROOTS", roots)
        found.append(sorted((r.record_id, r.text, r.start, r.end) for r in gazetteer_spans(rows, table).collect()))
    expected = [(0, "(North)", 29, 36), (0, "Hale", 8, 12), (0, "Hale Clinic", 8, 19), (0, "Leeds", 23, 28), (1, "Hale", 0, 4)]
    assert found == [expected, expected]


@pytest.mark.parametrize("roots", [0, 256])
def test_gazetteer_against_brute_force(spark, texts, monkeypatch, roots):
    """Names of any characters, those with a meaning in patterns too, by few and by many first tokens."""
    from noteloom.operators import entities

    monkeypatch.setattr(entities, "ROOTS", roots)
    rng = random.Random(13)
    pieces = ["\\", "s", "d", "b", "]", "[", "^", "-", "$", "|", "'", "\n", " ", "Ab", "é", "日", "😀", "_", "1", "."]
    make = lambda n: "".join(rng.choices(pieces, k=rng.randint(1, n)))
    names = sorted({make(4) for _ in range(60)} | {"Ab " * 40 + "Ab"})
    rows = texts(*[make(40) for _ in range(120)], "x " + "Ab " * 45 + "Ab.", "Ab-Ab", "", None)
    word = lambda c: c.isalnum() or c == "_"
    expected = []
    for r in rows.collect():
        text = r.raw_text or ""
        for name in names:
            for i in (i for i in range(len(text)) if text.startswith(name, i)):
                before, after = text[i - 1 : i] if i else "", text[i + len(name) : i + len(name) + 1]
                if not (before and word(before)) and not (after and word(after)):
                    expected.append((r.record_id, name, "ORG", i, i + len(name)))
    assert len(expected) > 100
    got = gazetteer_spans(rows, spark.createDataFrame([(n, "ORG") for n in names] * 2, "name string, label string"))
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_long_gazetteer_names_take_one_join(spark, texts):
    """What is put together meets the names once, however many tokens they have."""
    table = spark.createDataFrame([(" ".join(["Hale"] * 20), "ORG"), ("Leeds", "LOC")], "name string, label string")
    plan = gazetteer_spans(texts("Hale " * 25 + "of Leeds"), table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and plan.count("Join") == 1


def test_named_notes_are_dealt_by_record(spark, tmp_path):
    """Joins by few customers don't leave the notes in few parts."""
    from noteloom.plans import inputs

    spark.range(400).selectExpr("id AS event_id", "id AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, "Customer#1"), (1, "Customer#1b")], "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "red ring")], "p_partkey bigint, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(3000).selectExpr("id * 150 + 1 AS event_id", "id AS user_id").write.mode("append").parquet(f"{tmp_path}/events.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        notes = inputs.named_notes(spark, str(tmp_path))
        sizes = [r[1] for r in notes.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum(sizes) == 2 * 3003 and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 2


def test_texts_without_identifiers_stay(texts):
    rows = redact_structured(texts("nothing", "", None)).sort("record_id").collect()
    assert [(r.redacted_text, r.entities) for r in rows] == [("nothing", []), ("", []), (None, [])]
