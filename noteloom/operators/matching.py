"""Top-1 joins against a vocabulary of any size by text or vector similarity.

Texts meet by keys that two texts over the cutoff must share: pieces of a text and the places where they can stand, and for
the weighted ratio their words and stretches as well (:mod:`noteloom.functions.pieces`).  The keys are an equi-join, so
no text meets the whole vocabulary; what meets is compared exactly.  Keys that many texts share are dealt to cells.

Vectors meet by groups around pivots.  A group is skipped where the triangle inequality of angles says that none of
its vectors can be near enough; a vector of a group is, where its own angle or the first numbers of both say so.
"""

from __future__ import annotations

from math import acos

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions import pieces as P
from noteloom.functions import similarity as sim
from noteloom.functions.text import col, let, lit
from noteloom.functions.vocabulary import terms_df
from noteloom.operators.skew import dealt_join

# The shorter text of a pair compared by windows is that many times shorter at least.
SPREAD = 1.5
# Scales of the weighted ratio's parts.
WORDS_SCALE, WINDOW_SCALE = 0.95, 0.9
# Most pivots; they reach the rows as one value.
PIVOTS = 256
# Vectors of a block, and vectors that all copies of the blocks may add up to.
BLOCK, COPIES = 512, 4_000_000
# Numbers of a vector that are compared before the rest.
HEAD = 16
# Room for rounding in angles.
SLACK = 1e-6


def spread_terms(terms: DataFrame, term: str) -> DataFrame:
    """Distinct terms over a fixed number of tasks.

    Adaptive execution sizes partitions by bytes, but here the cost is in the rows: a few
    megabytes of terms can be hours of matching, so they must not end up in one task.
    """
    spark = terms.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # by a hash of its own: a repartitioning by the term itself would be dropped as already done
    return terms.repartition(tasks, F.xxhash64(term))


# --- texts -----------------------------------------------------------------------------------


def met(rows: DataFrame, vocabulary: DataFrame, term: str, probes: str, pieces: str, large: bool, also: str = "true") -> DataFrame:
    """``rows`` with ``cand``, a vocabulary row that shares a key with ``term``; once for each such key ``_key`` for which ``also`` holds.

    ``probes`` are the keys of a row and ``pieces`` those of a vocabulary row.  A row without partner stays, with ``cand``
    NULL.  Keys of a ``large`` vocabulary are counted, and those of many rows dealt to cells.
    """
    # a row without keys gets one of its own, so that such rows are not all in one place
    none = f"array(xxhash64('none', {col(term)}))"
    keys = let("me_k", f"array_distinct({probes})", f"if(size(me_k) = 0, {none}, me_k)")
    keyed = rows.select("*", F.explode(F.expr(keys)).alias("_key"))
    postings = vocabulary.select(F.explode(F.expr(f"array_distinct({pieces})")).alias("_key"), F.struct(*vocabulary.columns).alias("cand"))
    pairs = dealt_join(keyed, postings.hint("shuffle_hash"), "_key", term, "cand.term") if large else keyed.join(postings, "_key", "left")
    return pairs.withColumn("cand", F.expr(f"if({also}, cand, NULL)")).drop("_key")


def kept_best(pairs: DataFrame, rows: DataFrame, term: str, score: str, cutoff: float) -> DataFrame:
    """``rows`` with ``best``: ``struct<score, neg_ord, term>`` of the best ``cand`` at or over ``cutoff``; the first one wins ties."""
    best = let("kb_s", score, f"if(kb_s >= {lit(float(cutoff))}, named_struct('score', kb_s, 'neg_ord', -cand.ord, 'term', cand.term), NULL)")
    scored = pairs.select(*rows.columns, F.expr(f"if(cand IS NULL, NULL, {best})").alias("best"))
    return one_row(scored, rows, term)


def one_row(scored: DataFrame, rows: DataFrame, key: str, *more: Column) -> DataFrame:
    """The rows of each ``key`` as one, with the highest ``best``."""
    others = [F.first(c).alias(c) for c in rows.columns if c != key]
    out = scored.groupBy(key).agg(*others, F.max("best").alias("best"), *more)
    return out.select(*rows.columns, *[c for c in out.columns if c not in rows.columns])


def fuzzy_best(rows: DataFrame, vocabulary: DataFrame, cutoff: float, case_sensitive: bool = True, term: str = "term", unless: str = "false", min_length: int = 4, large: bool = True) -> DataFrame:
    """``rows`` with the best entry of ``vocabulary (term, ord)`` by plain ratio as ``best``.

    Terms under ``min_length`` characters and rows for which ``unless`` holds match nothing.
    """
    if not 0 < cutoff <= 100:
        raise ValueError("a cutoff is above 0 and at most 100")
    one, other = (col(term), "cand.term") if case_sensitive else (f"lower({col(term)})", "lower(cand.term)")
    limit, wanted = lit(float(cutoff)), f"length({col(term)}) >= {min_length} AND NOT ({unless})"
    probes = f"if({wanted}, {P.probe_keys(one, cutoff, 'p')}, {P.NO_KEYS})"
    pieces = P.piece_keys("term" if case_sensitive else "lower(term)", cutoff, "p")
    pairs = met(rows, vocabulary, term, probes, pieces, large)
    score = f"if({wanted} AND {sim.can_reach(one, other, limit)}, {sim.ratio(one, other, limit)}, 0D)"
    return kept_best(pairs, rows, term, score, cutoff)


def _weighted_keys(text: str, cutoff: float, own: bool) -> str:
    """The keys of a term (``own``) or of a vocabulary entry for the weighted ratio.

    Texts over the cutoff are so by the whole texts, by their sorted words, by their sorted distinct words, by a word in
    common, or by a window of the longer one, whole or with its words sorted.
    """
    whole, words, window = cutoff, cutoff / WORDS_SCALE, cutoff / WINDOW_SCALE
    write = P.probe_keys if own else P.piece_keys
    every, once = sim.joined("wk_w"), sim.joined("array_distinct(wk_w)")
    families = [write(text, whole, "p"), "transform(array_distinct(wk_w), wk_x -> xxhash64('t', wk_x))"]
    if words <= 100:
        families += [write(every, words, "s"), write(once, words, "d")]
    windows = [P.NO_KEYS]
    if window <= 100:
        # without the spaces that sorting drops, texts may be closer in length than they were
        for form, spread in ((text, SPREAD), (every, 1.0), (once, 1.0)):
            short, long = ("a", "b") if own else ("b", "a")
            windows += [P.window_piece_keys(form, window, short), P.window_probe_keys(form, window, long, spread)]
    # keys of windows are odd numbers, the others even
    keys = f"concat(transform(concat({', '.join(families)}), wk_k -> wk_k & -2L), transform(concat({', '.join(windows)}), wk_k -> wk_k | 1L))"
    return let("wk_w", sim.tokens(text), keys)


def _apart(term: str) -> str:
    """Whether a key says anything of a pair: those of windows do where one text is so much longer that windows count."""
    one, other = f"length({col(term)})", "length(cand.term)"
    return f"(_key & 1L) = 0 OR greatest({one}, {other}) >= {SPREAD}D * least({one}, {other})"


def weighted_best(rows: DataFrame, vocabulary: DataFrame, cutoff: float, term: str = "term", min_length: int = 4, large: bool = True) -> DataFrame:
    """``rows`` with the best entry of ``vocabulary (term, ord)`` by weighted ratio as ``best``."""
    return kept_best(weighted_pairs(rows, vocabulary, cutoff, term, min_length, large), rows, term, sim.weighted_ratio(col(term), "cand.term", cutoff), cutoff)


def weighted_pairs(rows: DataFrame, vocabulary: DataFrame, cutoff: float, term: str = "term", min_length: int = 4, large: bool = True) -> DataFrame:
    """``rows`` with every ``cand`` that can reach ``cutoff``, each once; one NULL for a row without any."""
    if not 0 < cutoff <= 100:
        raise ValueError("a cutoff is above 0 and at most 100")
    probes = f"if(length({col(term)}) >= {min_length}, {_weighted_keys(col(term), cutoff, True)}, {P.NO_KEYS})"
    pairs = met(rows, vocabulary, term, probes, _weighted_keys("term", cutoff, False), large, _apart(term))
    others = [F.first(c).alias(c) for c in rows.columns if c != term]
    once = pairs.groupBy(term, "cand").agg(*others) if others else pairs.select(term, "cand").distinct()
    return once.select(*rows.columns, "cand")


def _flat(rows: DataFrame, matched: str, score: str, *more: str) -> DataFrame:
    return rows.select(
        *[c for c in rows.columns if c not in ("best", *more)],
        F.col("best.term").alias(matched),
        F.col("best.score").alias(score),
        *more,
    )


def entries(spark, vocabulary: list[str] | DataFrame) -> tuple[DataFrame, bool]:
    """``(term, ord)`` with each term once, and whether it is a table, which may be large."""
    if isinstance(vocabulary, DataFrame):
        return vocabulary.filter("term IS NOT NULL").groupBy("term").agg(F.min("ord").alias("ord")), True
    return terms_df(spark, list(dict.fromkeys(vocabulary))), False


def fuzzy_join(terms: DataFrame, vocabulary: list[str] | DataFrame, threshold: float = 85, case_sensitive: bool = True, term: str = "term") -> DataFrame:
    """Add ``matched`` and ``score`` by plain ratio.  ``term`` is unique in ``terms``."""
    vocab, large = entries(terms.sparkSession, vocabulary)
    return _flat(fuzzy_best(spread_terms(terms, term), vocab, threshold, case_sensitive, term, large=large), "matched", "score")


def weighted_fuzzy_join(terms: DataFrame, vocabulary: list[str] | DataFrame, threshold: float = 75, term: str = "term") -> DataFrame:
    """Add ``matched`` and ``score`` by weighted ratio.  ``term`` is unique in ``terms``."""
    vocab, large = entries(terms.sparkSession, vocabulary)
    return _flat(weighted_best(spread_terms(terms, term), vocab, threshold, term, large=large), "matched", "score")


# --- vectors ---------------------------------------------------------------------------------


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def _once(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _angle(a: Column, b: Column, lengths: Column) -> Column:
    """The angle between two vectors, ``lengths`` being the product of theirs."""
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(a, b) / lengths)))


def prepared_vectors(vocabulary: DataFrame) -> DataFrame:
    """``(term, ord, vector, norm)`` from ``(term, ord, vector)``, without those that have no direction."""
    # a filter on the outer form stays above a grouping by term, so that only distinct terms are encoded
    sized = vocabulary.select("term", "ord", F.explode_outer(F.array("vector")).alias("vector"))
    sized = sized.select("*", F.expr(sim.norm("vector")).alias("norm"))
    return sized.filter("norm > 0")


def best_label(vector: str, labels: DataFrame, cutoff: float) -> str:
    """``struct<score, neg_ord, term>`` of the most similar of a few ``labels (term, ord, vector)`` that a list holds, row by row.

    The labels become a literal of the expression; no row carries them.
    """
    number = lambda x: lit(float(x))
    known = [f"named_struct('term', {lit(r.term)}, 'ord', {r.ord}, 'vector', array({', '.join(map(number, r.vector))}), 'norm', {number(r.norm)})"
             for r in prepared_vectors(labels).collect()]
    each = f"named_struct('score', if(bl_n > 0, {sim.dot('bl_v', 'bl_c.vector')} / (bl_n * bl_c.norm), 0D), 'neg_ord', -bl_c.ord, 'term', bl_c.term)"
    best = f"array_max(filter(transform(array({', '.join(known)}), bl_c -> {each}), bl_s -> bl_s.score >= {lit(float(cutoff))}))"
    return let("bl_v", vector, let("bl_n", sim.norm("bl_v"), best))


def vector_groups(vocabulary: DataFrame, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """Prepared vectors in groups around pivots: ``(pivot, part, members)`` blocks, and a row for each group.

    Pivots are the vectors first by a hash, a quarter of the root of their number; each vector belongs to the nearest.  Groups
    know the smallest and largest angle of their vectors to the pivot and their number of blocks.
    """
    number = vocabulary.agg(F.count("*")).scalar()
    wanted = F.least(F.lit(pivots), F.greatest(F.lit(1), F.floor(F.sqrt(number.cast("double")) / 4).cast("int")))
    first = vocabulary.select(F.xxhash64("term", "ord").alias("h"), "term", "vector", "norm").orderBy("h", "term").limit(pivots)
    chosen = F.slice(F.sort_array(first.agg(F.collect_list(F.struct("h", "term", "vector", "norm"))).scalar()), F.lit(1), wanted)
    angle = lambda p, i: F.struct(_angle(F.col("vector"), p["vector"], F.col("norm") * p["norm"]).alias("angle"), i.alias("pivot"), p.alias("p"))
    near = vocabulary.withColumn("pivots", chosen).withColumn("near", F.array_min(F.transform("pivots", angle)))
    placed = near.select("term", "ord", "vector", "norm", "near.pivot", "near.angle", "near.p")
    # a row for each pivot
    groups = placed.groupBy("pivot").agg(
        F.first("p").alias("p"), F.min("angle").alias("low"), F.max("angle").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")
    )
    head, tail = F.slice("vector", 1, HEAD), F.expr(sim.norm(f"slice(vector, {HEAD + 1}, greatest(size(vector) - {HEAD}, 0))"))
    member = F.struct("term", "ord", "vector", "norm", "angle", head.alias("head"), tail.alias("tail"))
    part = F.pmod(F.xxhash64("term", "ord"), F.col("parts")).cast("int").alias("part")
    sized = placed.drop("p").join(F.broadcast(groups.select("pivot", "parts")), "pivot")
    blocks = sized.select("pivot", part, member.alias("m")).groupBy("pivot", "part").agg(F.collect_list("m").alias("members"))
    return blocks, groups


def vector_best(rows: DataFrame, vocabulary: DataFrame, vector: str, cutoff: float, row_id: str = "term", unless: str = "false") -> DataFrame:
    """``rows`` with the nearest entry of ``vocabulary (term, ord, vector)`` by cosine as ``best``, and with ``pairs``, the number of
    vectors that the row's was compared with in full.

    ``vector`` is an expression; rows without a vector or direction, and rows for which ``unless`` holds, match nothing.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("a threshold is above 0 and at most 1")
    known, reach = prepared_vectors(vocabulary), acos(cutoff) + SLACK
    blocks, groups = vector_groups(known)
    # one value for all that the rows need to know: a few hundred groups at most
    about = groups.agg(F.struct(F.collect_list(F.struct("pivot", "p", "low", "high", "parts")).alias("groups"), F.sum("parts").alias("parts"))).scalar()
    # few vectors are copied to as many tasks as there are, many to some
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    many = F.coalesce(about["parts"], F.lit(1)) * BLOCK
    copies = F.greatest(F.lit(4), F.least(F.lit(tasks), F.floor(F.lit(COPIES) / many).cast("int")))
    salted = blocks.withColumnsRenamed({"pivot": "_pivot", "part": "_part"}).withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))

    with_vector = rows.withColumn("_v", F.expr(f"if({unless}, NULL, {vector})")).withColumn("_n", F.expr(sim.norm("_v"))).withColumn("_groups", about["groups"])

    def places(g: Column) -> Column:
        """The blocks of a group, with the row's angle to its pivot, unless they are out of reach."""
        return _once(
            _angle(F.col("_v"), g["p"]["vector"], F.col("_n") * g["p"]["norm"]),
            lambda t: F.when((t >= g["low"] - reach) & (t <= g["high"] + reach),
                             F.transform(F.sequence(F.lit(0), g["parts"] - 1), lambda i: F.struct(g["pivot"].alias("pivot"), i.alias("part"), t.alias("angle")))),
        )

    reached = F.flatten(F.filter(F.transform("_groups", places), lambda x: x.isNotNull()))
    own = F.when(F.col("_n") > 0, reached)
    spread = with_vector.select(*rows.columns, "_v", "_n", F.explode_outer(own).alias("_at")).select(
        *rows.columns, "_v", "_n", F.col("_at.angle").alias("_angle"),
        # rows without a block are dealt out like others
        F.coalesce("_at.pivot", (-1 - F.pmod(F.xxhash64(row_id), F.lit(tasks))).cast("int")).alias("_pivot"), F.coalesce("_at.part", F.lit(0)).alias("_part"),
        F.pmod(F.xxhash64(row_id), copies).cast("int").alias("_salt"),
    )
    # first by the angle to the pivot, then by the first numbers and the length of the rest, then in full
    limit = lit(float(cutoff))
    first = sim.dot("slice(_v, 1, " + str(HEAD) + ")", "vb_m.head")
    near = f"""filter(members, vb_m -> abs(vb_m.angle - _angle) <= {lit(reach)}
      AND {first} + _tail * vb_m.tail >= ({limit} - {lit(SLACK)}) * _n * vb_m.norm)"""
    each = f"named_struct('score', {sim.dot('_v', 'vb_c.vector')} / (_n * vb_c.norm), 'neg_ord', -vb_c.ord, 'term', vb_c.term)"
    best = f"named_struct('pairs', size(vb_k), 'best', array_max(filter(transform(vb_k, vb_c -> {each}), vb_s -> vb_s.score >= {limit})))"
    tail = sim.norm(f"slice(_v, {HEAD + 1}, greatest(size(_v) - {HEAD}, 0))")
    joined = spread.withColumn("_tail", F.expr(tail)).join(salted, ["_pivot", "_part", "_salt"], "left")
    scored = joined.select(*rows.columns, F.explode_outer(F.expr(f"array(if(members IS NULL, NULL, {let('vb_k', near, best)}))")).alias("_b"))
    scored = scored.select(*rows.columns, "_b.best", "_b.pairs")
    return one_row(scored, rows, row_id, F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))


def vector_join(rows: DataFrame, vocabulary: DataFrame, threshold: float = 0.86, row_id: str = "term", vector: str = "vector", counted: bool = False) -> DataFrame:
    """Add ``matched`` and ``score`` by cosine with ``vocabulary (term, ord, vector)``; with ``counted`` also ``pairs``, the number of
    vectors compared in full.  ``row_id`` is unique in ``rows``."""
    found = vector_best(rows, vocabulary, col(vector), threshold, row_id)
    return _flat(found if counted else found.drop("pairs"), "matched", "score", *(["pairs"] if counted else []))


def label_top1(scores: DataFrame, threshold: float = 0.2, key: str = "record_id") -> DataFrame:
    """Best label per record from ``(key, label, ord, score)``, kept if it reaches ``threshold``."""
    best = scores.groupBy(key).agg(
        F.max(F.struct("score", (-F.col("ord")).alias("neg_ord"), "label")).alias("b")
    )
    return best.filter(F.col("b.score") >= threshold).select(key, "b.label", "b.score")
