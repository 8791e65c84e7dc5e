import random
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from noteloom.functions import pieces as P
from noteloom.functions import similarity as sim
from noteloom.functions.vocabulary import BREEDS, DIAGNOSES, abbreviations_df
from noteloom.operators import matching
from noteloom.operators.extract import extract_patterns
from noteloom.operators.matching import fuzzy_join, label_top1, vector_join, weighted_fuzzy_join
from noteloom.operators.skew import dealt_join, heavy_keys, salted_join
from noteloom.operators.standardise import cascade, encoded_terms, fallback_label, lookup, match_terms, method_distribution, standardise_patterns, term_counts
from noteloom.plans import inputs


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@lru_cache(None)
def ratio(a, b):
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a, b):
    if not a or not b:
        return 100.0 if not a and not b else 0.0
    ways = [(a, b)] if len(a) < len(b) else [(b, a)] if len(b) < len(a) else [(a, b), (b, a)]
    return max(
        ratio(s, w)
        for s, long in ways
        for w in {long[max(i, 0) : i + len(s)] for i in range(1 - len(s), len(long))}
        if w
    )


def weighted(a, b):
    ta, tb = a.split(), b.split()
    sa, sb, ua, ub = " ".join(sorted(ta)), " ".join(sorted(tb)), set(ta), set(tb)
    plain, spread = ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    if spread < 1.5:
        common, da, db = (" ".join(sorted(s)) for s in (ua & ub, ua - ub, ub - ua))
        if common and (not da or not db):
            tset = 100.0
        else:
            glue = 1 if common else 0
            base = 2 * (len(common) + glue) + len(da) + len(db)
            tset = 100 - 100 * (len(da) + len(db) - 2 * lcs(da, db)) / base
            if common:
                tset = max(tset, *(100 - 100 * (1 + len(d)) / (2 * len(common) + 1 + len(d)) for d in (da, db)))
        return max(plain, 0.95 * max(ratio(sa, sb), tset))
    scale = 0.9 if spread <= 8 else 0.6
    tokens = 100.0 if ua & ub else max(partial(sa, sb), partial(" ".join(sorted(ua)), " ".join(sorted(ub))))
    return max(plain, scale * partial(a, b), 0.95 * scale * tokens)


PAIRS = [
    ("abcess", "Abscess"), ("Otitis extena", "Otitis externa"), ("Vomitting", "Vomiting"), ("", "abc"), ("abc", ""), ("", ""),
    ("x" * 70 + "ab", "ab" + "x" * 65), ("aé🙂b", "é🙂c"), ("new york mets", "mets york new"), ("a b c", "a b c d e f g"),
    ("the bull dog", "bulldog"), ("dog dog cat", "cat dog"), ("spaniel", "a spaniel of great age and kindness"), ("ab", "ab cd ef gh ij kl mn op qr"),
    ("fuzzy was a bear", "fuzzy fuzzy was a bear"), ("abcd", "dcba"), ("  spaced   out ", "out spaced"), ("abcde", "xabcdx abcde"),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "a string, b string")


def test_ratio_equals_plain_table(pairs):
    for r in pairs.select("a", "b", F.expr(sim.ratio("a", "b")).alias("s"), F.expr(sim._lcs_table("a", "b")).alias("t")).collect():
        assert r.s == pytest.approx(ratio(r.a, r.b)) and r.t == lcs(r.a, r.b), (r.a, r.b)


def test_published_ratios(pairs):
    got = {r.a: r.s for r in pairs.select("a", F.expr(sim.ratio("a", "b")).alias("s")).collect()}
    assert [round(got[t], 2) for t in ("abcess", "Otitis extena", "Vomitting")] == [76.92, 96.30, 94.12]


def test_partial_and_weighted_equal_plain_python(pairs):
    rows = pairs.select("a", "b", F.expr(sim.partial_ratio("a", "b")).alias("p"), F.expr(sim.weighted_ratio("a", "b")).alias("w")).collect()
    for r in rows:
        assert r.p == pytest.approx(partial(r.a, r.b)), (r.a, r.b)
        assert r.w == pytest.approx(weighted(r.a, r.b) if r.a and r.b else 0.0), (r.a, r.b)


def best(term, vocabulary, score, cutoff):
    if len(term) < 4:
        return None, None
    top = max(vocabulary, key=lambda v: score(term, v))
    return (top, pytest.approx(score(term, top))) if score(term, top) >= cutoff else (None, None)


@pytest.mark.parametrize(
    "join,vocabulary,score,cutoff,source",
    [(fuzzy_join, DIAGNOSES, ratio, 85, inputs.misspelt_diagnoses), (weighted_fuzzy_join, BREEDS, weighted, 75, inputs.misspelt_breeds)],
)
def test_top1_equals_brute_force(spark, sf_dir, join, vocabulary, score, cutoff, source):
    terms = source(spark, sf_dir).select("term").distinct()
    for r in join(terms, vocabulary).collect():
        assert (r.matched, r.score) == best(r.term, vocabulary, score, cutoff), r.term


def test_a_table_gives_the_same_as_a_list(spark, sf_dir):
    terms = inputs.misspelt_diagnoses(spark, sf_dir).select("term").distinct()
    names = spark.createDataFrame([(t, i) for i, t in enumerate(DIAGNOSES)] + [(None, 99), ("Abscess", 100)], "term string, ord int")
    for join in (fuzzy_join, weighted_fuzzy_join):
        by_list, by_table = join(terms, DIAGNOSES), join(terms, names)
        assert by_list.count() == by_table.count() and by_list.exceptAll(by_table).count() == 0


def random_texts(seed, letters, n, longest):
    rng = random.Random(seed)
    return list(dict.fromkeys("".join(rng.choices(letters, k=rng.randint(0, longest))) for _ in range(n)))


@pytest.mark.parametrize("cutoff", [30, 60, 75, 85, 95, 100])
def test_pieces_lose_no_match(spark, cutoff):
    vocabulary, own = random_texts(1, "abc ", 120, 14) + ["é🙂b", "é🙂c"], random_texts(2, "abc ", 120, 16) + ["aé🙂b"]
    terms = spark.createDataFrame([(t, i) for i, t in enumerate([*own, None])], "term string, term_no int")
    names = spark.createDataFrame(list(zip(vocabulary, range(999), strict=False)), "term string, ord int")
    got = {r.term: (r.matched, r.score) for r in fuzzy_join(terms, names, cutoff).collect()}
    assert got.pop(None) == (None, None)
    assert got == {t: best(t, vocabulary, ratio, cutoff) for t in own}


def test_large_vocabularies(spark):
    """Names of ten syllables share many pieces; even so few pairs meet, and the best is that of all."""
    rng = random.Random(3)
    parts = ["ka", "lor", "min", "tes", "bra", "vel", "on", "ix", "dur", "pho"]
    names = list(dict.fromkeys("".join(rng.choices(parts, k=rng.randint(3, 7))) for _ in range(20_000)))
    own = []
    for name in rng.sample(names, 40):
        at = rng.randrange(len(name))
        own += [name[:at] + name[at + 1 :], name[:at] + "z" + name[at:]]
    terms = spark.createDataFrame([(t,) for t in dict.fromkeys(own)], "term string")
    table = spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "term string, ord int")
    got = {r.term: r.score for r in fuzzy_join(terms, table).collect()}
    near = {t: [n for n in names if abs(len(n) - len(t)) <= 0.15 * (len(n) + len(t))] for t in got}
    for t in list(got)[:12]:
        assert got[t] == pytest.approx(max(ratio(t, n) for n in near[t])), t
    met = matching.met(terms, table, "term", P.probe_keys("term", 85, "p"), P.piece_keys("term", 85, "p"), True)
    assert met.filter("cand IS NOT NULL").select("term", "cand.term").distinct().count() < 0.1 * len(names) * len(got)


@pytest.mark.parametrize("cutoff", [50, 75, 90])
def test_weighted_candidates_lose_no_match(spark, cutoff):
    rng = random.Random(4)
    words = ["ab", "abc", "ca", "cab", "bull", "dog", "bulldog", "of", "a", "great", "age"]
    phrases = lambda n: list(dict.fromkeys(" ".join(rng.choices(words, k=rng.randint(1, 7))) for _ in range(n)))
    vocabulary, own = phrases(40), phrases(25) + random_texts(5, "abc dog", 25, 14)
    terms = spark.createDataFrame([(t,) for t in own], "term string")
    names = spark.createDataFrame(list(zip(vocabulary, range(999), strict=False)), "term string, ord int")
    got = {r.term: r.score for r in weighted_fuzzy_join(terms, names, cutoff).collect()}
    assert got == {t: best(t, vocabulary, weighted, cutoff)[1] for t in own}


def test_cells_of_heavy_keys(spark):
    left = spark.range(400).select(F.col("id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 20).alias("k"))
    right = spark.range(300).select(F.col("id").alias("other"), F.when(F.col("id") % 2 > 0, 7).otherwise(F.col("id") % 15).alias("k"))
    plain = left.join(right, "k")
    got = dealt_join(left, right, "k", "id", "other", "inner", 16)
    assert got.count() == plain.count() and got.exceptAll(plain.select(*got.columns)).count() == 0
    kept = dealt_join(left, right, "k", "id", "other", cell=16).select("id").distinct()
    assert kept.count() == 400


def test_case_switch_and_short_terms(spark):
    terms = spark.createDataFrame([("abcess",), ("OA",), ("Abscess",)], "term string")
    strict = {r.term: r.matched for r in fuzzy_join(terms, DIAGNOSES).collect()}
    loose = {r.term: (r.matched, round(r.score, 1)) for r in fuzzy_join(terms, DIAGNOSES, case_sensitive=False).collect() if r.matched}
    assert strict == {"abcess": None, "OA": None, "Abscess": "Abscess"}
    assert loose == {"abcess": ("Abscess", 92.3), "Abscess": ("Abscess", 100.0)}


def test_first_candidate_wins_ties_and_cutoff_is_inclusive(spark):
    terms = spark.createDataFrame([("abcdefghijklmnopqrst",)], "term string")
    # 17 of 20 letters in common: exactly 85
    near = "abcdefghijklmnopqxyz"
    row = fuzzy_join(terms, [near.upper(), near, near[::-1], near[:-3] + "zyx"]).first()
    assert (row.matched, row.score) == (near, 85.0)


def test_vectors(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("z", [0.0, 0.0])], "term string, vector array<float>")
    vocab = spark.createDataFrame([("x", 0, [2.0, 0.0]), ("y", 1, [0.0, 3.0])], "term string, ord int, vector array<float>")
    got = {r.term: (r.matched, r.score) for r in vector_join(rows, vocab, 0.7).collect()}
    assert got == {"a": ("x", 1.0), "b": ("x", pytest.approx(0.5**0.5)), "z": (None, None)}
    with pytest.raises(ValueError, match="threshold"):
        vector_join(rows, vocab, 0)


@pytest.mark.parametrize(("cutoff", "share"), [(0.86, 0.05), (0.5, 0.6), (0.22, 1)])
def test_groups_of_vectors_lose_no_match(spark, cutoff, share):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32))
    known = np.concatenate([c + 0.25 * rng.normal(size=(60, 32)) for c in centres]).astype("f4").astype(float)
    asked = np.concatenate([centres[:20] + 0.3 * rng.normal(size=(20, 32)), rng.normal(size=(30, 32)), known[:5], np.zeros((1, 32))]).astype("f4").astype(float)
    vocabulary = spark.createDataFrame([(f"v{i}", i, x.tolist()) for i, x in enumerate(known)] + [("zero", -1, [0.0] * 32), ("none", -2, None)], "term string, ord int, vector array<float>")
    rows = spark.createDataFrame([(f"q{i}", x.tolist(), i) for i, x in enumerate(asked)] + [("none", None, 1)], "term string, vector array<float>, pivot int")
    got = {r.term: r for r in vector_join(rows, vocabulary, cutoff, counted=True).collect()}
    assert got["none"].matched is None and got["none"].pairs == 0 and len(got) == len(asked) + 1
    for i, x in enumerate(asked):
        cosine = known @ x / np.maximum(np.linalg.norm(x) * np.linalg.norm(known, axis=1), 1e-12)
        top = int(cosine.argmax())
        row = got[f"q{i}"]
        assert (row.matched, row.score) == ((f"v{top}", pytest.approx(cosine[top])) if cosine[top] >= cutoff else (None, None))
    assert sum(r.pairs for r in got.values()) < share * len(asked) * len(known)


def test_label_top1(spark):
    scores = spark.createDataFrame([(1, "b", 1, 0.3), (1, "a", 0, 0.3), (2, "a", 0, 0.1), (3, "b", 1, 0.2)], "record_id long, label string, ord int, score double")
    assert {tuple(r) for r in label_top1(scores).collect()} == {(1, "a", 0.3), (3, "b", 0.2)}


def spans(spark, *terms):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(terms or ["none"])], "record_id long, ord int, entity string")


def test_cascade_tiers(spark):
    rows = cascade(spans(spark, "oa", "RH", "Otitis extena", "GI upset", "gi UPSET", "sore paw", None), semantic_threshold=0.86).collect()
    got = {r.raw: (r.standard, r.method) for r in rows}
    assert got == {
        "oa": ("Osteoarthritis", "exact_match"), "RH": ("Right Hind", "exact_match"), "Otitis extena": ("Otitis externa", "fuzzy_match"),
        "GI upset": ("Acute gastroenteritis", "exact_match"), "gi UPSET": ("gi UPSET", "unmatched"), "sore paw": ("sore paw", "unmatched"), None: (None, "unmatched"),
    }


def test_folded_keys_and_semantic_tier(spark):
    matched = match_terms(term_counts(spans(spark, "gi upset", "abcess", "abcess")), fold_keys=True, semantic_threshold=0.5)
    got = {r.term: (r.standard, r.method, r.n_spans) for r in matched.collect()}
    assert got == {"gi upset": ("Acute gastroenteritis", "exact_match", 1), "abcess": ("Abscess", "semantic_match", 2)}


def test_hot_term_keeps_every_span(spark):
    many = spark.range(30000).select(F.col("id").alias("record_id"), F.lit(0).alias("ord"), F.when(F.col("id") % 3 == 0, "OA").otherwise(F.concat(F.lit("term "), "id")).alias("entity"))
    rows = cascade(many)
    assert rows.count() == 30000 and rows.filter("method = 'exact_match'").count() == 10000


def test_heavy_keys_join_like_others(spark):
    rows = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("most"))
    heavy = heavy_keys(groups, ["k"], "n", 30)
    assert sorted(r._places for r in heavy.collect())[-1] == 17
    found = salted_join(rows, groups, ["k"], heavy, "id")
    plain = rows.join(groups.withColumnRenamed("k", "g"), F.col("k").eqNullSafe(F.col("g"))).drop("g")
    assert found.count() == 2000 and found.select(*plain.columns).exceptAll(plain).count() == 0


def test_methods_partition_the_spans(notes):
    of_notes = inputs.spans_of(notes)
    assert method_distribution(of_notes).agg(F.sum("n")).first()[0] == of_notes.count()


def test_fallback_only_without_diagnosis(spark, texts):
    rows = texts("vomiting, vomiting and more vomiting", "xyz", "vomiting")
    got = fallback_label(rows, "record_id = 0")
    assert [(r.record_id, r.standard, r.method) for r in got.collect()] == [(0, "Vomiting", "zero_shot")]
    late = texts("x" * 600 + " vomiting" * 200)
    found = fallback_label(late, "true")
    assert found.first().standard == "Vomiting"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange hash" not in plan


def test_given_vectors(spark):
    terms = term_counts(spans(spark, "OA", "a", "b", "c", "d"))
    given = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("d", [0.0, 0.0])], "term string, vector array<float>")
    known = spark.createDataFrame([("x", 0, [3.0, 0.0]), ("y", 1, [0.0, 1.0])], "term string, ord int, vector array<float>")
    matched = match_terms(terms, term_vectors=given, diagnosis_vectors=known)
    assert {r.term: (r.standard, r.method) for r in matched.collect()} == {
        "OA": ("Osteoarthritis", "exact_match"), "a": ("x", "semantic_match"), "b": ("y", "semantic_match"), "c": ("c", "unmatched"), "d": ("d", "unmatched"),
    }
    with pytest.raises(ValueError, match="together"):
        match_terms(terms, term_vectors=given)


def test_a_vocabulary_table_gives_the_same_and_deals_hot_keys(spark, texts):
    items = extract_patterns(texts(*["HR 90 BAR 4kg"] * 200, "oa NAD", "qar CRT 1", None))
    plain = standardise_patterns(items)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = standardise_patterns(items, abbreviations_df(spark))
        assert table.count() == plain.count() and table.exceptAll(plain).count() == 0
        key, rows = F.expr("upper(raw)"), items.select("record_id", "raw")
        places = lookup(rows, key, abbreviations_df(spark)).filter("standard IS NOT NULL")
        assert places.exceptAll(lookup(rows, key, abbreviations_df(spark), places=1)).count() == 0 and places.count() > 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_vocabulary_rows_keep_one_row_an_item(spark):
    rows = [("OA", "first", "g", 0), ("OA", "last", "h", 1), ("oa", "folded", "i", 2), ("oA", "other", "j", 3), (None, "none", "k", 4)]
    vocabulary = spark.createDataFrame(rows, "term string, canonical string, category string, ord int")
    for fold, expected in ((False, "last"), (True, "other")):
        found = match_terms(term_counts(spans(spark, "OA")), vocabulary, fold_keys=fold).collect()
        assert [(r.standard, r.method) for r in found] == [(expected, "exact_match")]


def test_names_are_encoded_once_however_often_they_occur(spark):
    """The check of a vector's direction stays above the grouping of a table's names."""
    names = spark.range(20).select(F.concat(F.lit("name "), (F.col("id") % 3).cast("string")).alias("term"), F.col("id").alias("ord"))
    known = matching.prepared_vectors(encoded_terms(names.groupBy("term").agg(F.min("ord").alias("ord"))))
    below = known._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)[1].split("\n", 1)[1]
    assert "lambda" not in below
    assert sorted((r.term, r.ord, len(r.vector) > 0) for r in known.collect()) == [("name 0", 0, True), ("name 1", 1, True), ("name 2", 2, True)]
