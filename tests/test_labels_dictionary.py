"""Label centroids, the dictionary of matches, and sketches."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from noteloom.operators import dictionary, labels, quality
from noteloom.operators.standardise import cascade, fallback_label, match_terms, term_counts
from noteloom.sources.folders import fresh_folder

TEXTS = [
    "vomiting since monday, vomiting", "has been vomiting the grass", "itchy skin and the red skin", "skin is the red", "limping left hind the leg", "the leg of the dog", "", None,
]
LABELS = {0: ["gut"], 1: ["gut", "diet"], 2: ["skin"], 3: ["skin"], 4: ["leg"], 5: ["leg"]}
ASKED = ["vomiting again", "red itchy skin, vomiting", "the", "nothing known here", "Leg LEG", "", None]


def words_of(text):
    return Counter(re.findall(r"\w+", (text or "").lower()))


def plain_scores(texts, of, asked):
    words = [words_of(t) for t in texts]
    n = sum(bool(w) for w in words)
    weight = {w: math.log((1 + n) / (1 + sum(w in own for own in words))) for own in words for w in own}

    def unit(vector):
        length = math.sqrt(sum(x * x for x in vector.values()))
        return {w: x / length for w, x in vector.items()} if length else {}

    def vector(own):
        return unit({w: c * weight[w] for w, c in own.items() if weight.get(w, 0) > 0})

    sums = defaultdict(Counter)
    for i, own in of.items():
        for label in own:
            sums[label].update(vector(words[i]))
    centre = {label: unit(s) for label, s in sums.items()}
    out = {}
    for i, text in enumerate(asked):
        mine = vector(words_of(text))
        for label, c in centre.items():
            if set(mine) & set(c):
                out[i, label] = sum(x * c.get(w, 0) for w, x in mine.items())
    return out


def test_label_scores_equal_plain(spark, texts):
    of = spark.createDataFrame([(i, label, ord(label[0])) for i, own in LABELS.items() for label in own] * 2, "record_id long, label string, ord int")
    weights, learnt = labels.learnt_labels(texts(*TEXTS), of)
    scores = labels.scored_notes(texts(*ASKED), weights, learnt)
    got = {(r.record_id, r.label): r.score for r in scores.collect()}
    expected = plain_scores(TEXTS, LABELS, ASKED)
    assert got == {k: pytest.approx(v) for k, v in expected.items()} and len(got) > 5
    best = {r.record_id: r.standard for r in fallback_label(texts(*ASKED), "record_id <> 1", scores=scores).collect()}
    assert best == {0: "gut", 4: "leg"}
    assert labels.scored_notes(texts(*ASKED).limit(0), weights, learnt).count() == 0


def spans(spark, *terms):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(terms)], "record_id long, ord int, entity string")


def test_second_run_matches_nothing(spark):
    folder = fresh_folder(spark, "test-matches")
    first = spans(spark, "oa", "Otitis extena", "sore paw", "oa", None, "RH")
    for _ in range(2):
        got = dictionary.cascade_with_dictionary(first, folder)
        assert sorted(map(str, got.collect())) == sorted(map(str, cascade(first).collect()))
    _, unseen = dictionary.matched_terms(term_counts(first), folder)
    assert unseen.count() == 0
    matches, unseen = dictionary.matched_terms(term_counts(spans(spark, "abcess", "oa")), folder)
    assert {r.term for r in unseen.collect()} == {"abcess"} and matches.count() == 5


def test_a_changed_vocabulary_or_threshold_starts_anew(spark):
    folder = fresh_folder(spark, "test-matches")
    terms = term_counts(spans(spark, "Otitis extena", "abcess"))
    known = spark.createDataFrame([("Otitis", 0), ("Abscess", 1)], "term string, ord int")
    for options in ({}, {"fuzzy_threshold": 60}, {"diagnoses": known}, {"diagnoses": known.limit(1)}, {"case_sensitive": False}, {"semantic_threshold": 0.3}):
        matches, unseen = dictionary.matched_terms(terms, folder, **options)
        assert unseen.count() == 2, options
        plain = match_terms(terms, **options).select("term", "standard", "score", "method")
        assert sorted(map(str, matches.collect())) == sorted(map(str, plain.collect()))
    assert len({dictionary.fingerprint(spark), dictionary.fingerprint(spark, fuzzy_threshold=85), dictionary.fingerprint(spark, fold_keys=True)}) == 2
    with pytest.raises(ValueError, match="not kept"):
        dictionary.matched_terms(terms, folder, term_vectors=known)


def test_sketches_merge_to_the_whole(spark):
    rng = random.Random(4)
    values = [f"text {rng.randint(0, 30_000)}" for _ in range(40_000)] + [None] * 5
    rows = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "t string, part int")
    parts = quality.distinct_sketches(rows, ["t"], ["part"])
    assert parts.count() == 7
    whole = quality.approximate_uniqueness(quality.distinct_sketches(rows, ["t"])).first()
    merged = quality.approximate_uniqueness(quality.merged_sketches(parts)).first()
    exact = len(set(values))
    assert merged.n == whole.n == len(values)
    assert abs(merged.distinct_keys - exact) <= merged.error * exact
    assert abs(merged.distinct_keys - whole.distinct_keys) <= merged.error * exact
    two = quality.approximate_uniqueness(quality.distinct_sketches(rows, ["t", "part"])).first()
    assert abs(two.distinct_keys - rows.distinct().count()) <= two.error * len(values)
    assert quality.distinct_sketches(rows.limit(0), ["t"], ["part"]).count() == 0


def test_report_reads_its_input_once(spark, tmp_path):
    six = [(d, 0.1 * i, 0.5) for i, d in enumerate(quality.DIMENSIONS)]
    path = str(tmp_path / "six")
    spark.createDataFrame(six, "dimension string, before double, after double").write.parquet(path)
    report = quality.quality_report(spark.read.parquet(path))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.dimension: (round(r.before, 6), round(r.after, 6), round(r.delta, 6)) for r in report.collect()}["OVERALL"] == (0.25, 0.5, 0.25)


@pytest.mark.parametrize("frequent", [1, 8])
def test_label_scores_with_broadcast_and_shuffled_words(spark, texts, monkeypatch, frequent):
    """Words that are broadcast and words that are shuffled give the same scores."""
    monkeypatch.setattr(labels, "FREQUENT", frequent)
    of = spark.createDataFrame([(i, label, ord(label[0])) for i, own in LABELS.items() for label in own], "record_id long, label string, ord int")
    weights = labels.learnt_labels(texts(*TEXTS), of)[0].cache()
    learnt = labels.learnt_labels(texts(*TEXTS), of, weights=weights)[1].cache()
    got = {(r.record_id, r.label): r.score for r in labels.scored_notes(texts(*ASKED), weights, learnt).collect()}
    assert got == {k: pytest.approx(v) for k, v in plain_scores(TEXTS, LABELS, ASKED).items()}
