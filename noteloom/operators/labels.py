"""Label scores from the notes themselves: term weights of each label, learnt from annotated notes.

A note is the set of its words with how often each stands in it, times the word's inverse document frequency, scaled to length one.
A label's centroid is the mean of the notes that have it, scaled to length one.  The score of a note and a label is the
cosine of the two: a sparse sum over the words they share, made by a join on words.  Words of all notes weigh nothing and are left
out.  Nearly all words of a text are frequent ones, and there are few of these: they are broadcast, and the rows stay where their note
is.  Only the others are shuffled by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions.patterns import WORD
from noteloom.functions.text import all_matches, col

# Words, or words times labels, that are broadcast at most: each has more than this part of all rows.
FREQUENT = 100_000


def note_words(notes: DataFrame, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """``(key, word, n)``: how often each word stands in a note, in small letters."""
    # a note's text moves once, and no word of it; a fixed number of tasks, as the words are many times what the texts are
    spark = notes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = notes.select(key, text).repartition(tasks, key)
    words = placed.select(F.col(key), F.explode(F.expr(all_matches(f"lower({col(text)})", f"{WORD}+"))).alias("word"))
    return words.groupBy(key, "word").agg(F.count("*").alias("n"))


def word_weights(words: DataFrame, key: str = "record_id", total: Column | None = None) -> DataFrame:
    """``(word, n_notes, weight)``: inverse document frequency of each word, ``ln((1 + notes) / (1 + notes with it))``.

    ``words`` come from :func:`note_words`.  A word of all notes has weight 0 and is left out.  ``total``, the number of notes with a
    word, is counted from them if it is not given.
    """
    counts = words.groupBy("word").agg(F.count("*").alias("n_notes"))
    total = words.select(key).distinct().agg(F.count("*")).scalar() if total is None else total
    weight = F.ln((F.lit(1.0) + total) / (F.lit(1.0) + F.col("n_notes")))
    return counts.withColumn("weight", weight).filter("weight > 0")


def _by_word(rows: DataFrame, words: DataFrame, each: int | Column = 1) -> DataFrame:
    """``rows (key, word, ...)`` joined to ``words (word, n_notes, ...)``, one row a word of ``each`` values.

    Frequent words are broadcast.  The rows of the others are joined by a shuffle, which splits what is uneven.
    """
    total = words.agg(F.sum("n_notes")).scalar()
    frequent = F.col("n_notes") * FREQUENT > total * each
    many, few = words.filter(frequent).drop("n_notes"), words.filter(~frequent).drop("n_notes")
    rest = rows.join(F.broadcast(many.select("word")), "word", "left_anti").hint("merge").join(few, "word")
    return rows.join(F.broadcast(many), "word").unionByName(rest)


def note_vectors(words: DataFrame, weights: DataFrame, key: str = "record_id") -> DataFrame:
    """``(key, word, x)`` of length one for each note; words without a weight are left out, and so are notes of none but such."""
    placed = _by_word(words, weights.select("word", "n_notes", "weight"))
    # by the note: the length and the scaling share one shuffle
    raw = placed.select(key, "word", (F.col("n") * F.col("weight")).alias("x"))
    whole = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), F.collect_list(F.struct("word", "x")).alias("w"))
    return whole.select(key, F.explode(F.transform("w", lambda e: F.struct(e["word"].alias("word"), (e["x"] / F.col("length")).alias("x")))).alias("e")).select(key, "e.*")


def centroids(vectors: DataFrame, labelled: DataFrame, key: str = "record_id") -> DataFrame:
    """``(label, ord, word, x, n)`` of length one for each label; ``n`` of its notes have the word.

    ``labelled (key, label, ord)`` says which notes have which labels, one row for each pair; ``ord`` decides ties later.
    """
    sums = vectors.join(labelled.select(key, "label", "ord").distinct().hint("shuffle_hash"), key).groupBy("label", "word").agg(F.sum("x").alias("x"), F.count("*").alias("n"), F.min("ord").alias("ord"))
    lengths = sums.groupBy("label").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), F.min("ord").alias("first"))
    # a row for each label
    return sums.join(F.broadcast(lengths), "label").select("label", F.col("first").alias("ord"), "word", (F.col("x") / F.col("length")).alias("x"), "n")


def label_scores(vectors: DataFrame, learnt: DataFrame, key: str = "record_id") -> DataFrame:
    """``(key, label, ord, score)``: the cosine of each note with each label that it shares a word with.

    A word of the centroids is one row with its weight in every label, so a note's word meets one row; the
    number of labels bounds what follows from it.
    """
    by_word = learnt.groupBy("word").agg(F.sum("n").alias("n_notes"), F.collect_list(F.struct("label", "ord", F.col("x").alias("y"))).alias("labels"))
    met = _by_word(vectors, by_word, learnt.agg(F.countDistinct("label")).scalar())
    parts = met.select(key, "x", F.inline("labels"))
    return parts.groupBy(key, "label", "ord").agg(F.sum(F.col("x") * F.col("y")).alias("score"))


def learnt_labels(notes: DataFrame, labelled: DataFrame, text: str = "raw_text", key: str = "record_id", weights: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(weights, centroids)`` from annotated notes: all that scoring needs, small enough to be written and kept.

    ``weights`` of the same notes that were written before are not learnt again.
    """
    words = note_words(notes, text, key)
    if weights is None:
        # the texts need not be taken apart for this
        total = notes.filter(F.col(text).rlike(WORD)).select(key).distinct().agg(F.count("*")).scalar()
        weights = word_weights(words, key, total)
    return weights, centroids(note_vectors(words, weights, key), labelled, key)


def scored_notes(notes: DataFrame, weights: DataFrame, learnt: DataFrame, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """``(key, label, ord, score)`` of notes that may be other ones than the labels were learnt from."""
    return label_scores(note_vectors(note_words(notes, text, key), weights, key), learnt, key)
