"""Preference pairs for chat training: one prompt, two completions with masks.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# How a turn is written, and the roles a model is trained to write
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = ("assistant",)
BLOCK = 1024


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of ``(conv_id, turn, role, text)`` rows; turns are structs of role and text.

    Ordered by turn number (null first), then role and text, so equal numbers have a fixed order and repeated rows
    stay.  A null role or text is an empty one.  Rows without ``conv_id`` belong to none and are left out.
    One conversation is one value: it must fit in memory, as a training example must.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", F.struct("turn", role, text).alias("said"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return listed.select("conv_id", F.transform("said", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _safe(text: Column) -> Column:
    """A text can't write a marker: a blank parts its two characters."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit(BETWEEN), _safe(turn["text"]), F.lit(CLOSE))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Where trained turns are written in the rendered completion: ``(start, length)`` in characters.

    A span covers what the model writes, text and closing marker; all else is masked.
    """
    sizes = F.transform(turns, lambda t: F.length(_rendered(t)))
    start = F.lit(0)

    def span(turn: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(sizes, F.lit(1), i), start, lambda a, x: a + x)
        head = F.length(_safe(turn["role"])) + len(OPEN) + len(BETWEEN)
        begin = F.when(turn["role"].isin(*TRAINED), before + head)
        return F.struct(begin.alias("start"), (F.length(_safe(turn["text"])) + len(CLOSE)).alias("length"))

    return F.filter(F.transform(turns, span), lambda s: s["start"].isNotNull())


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` of ``chosen`` and ``rejected`` turn arrays, with the prompt both share and two masked completions.

    Adds ``prompt_turns``, ``prompt``, ``chosen_text``, ``rejected_text``, ``chosen_spans`` and ``rejected_spans``.  The prompt is the
    longest run of first turns that are equal in role and text, written once.  A null array is an empty
    conversation.  Equal conversations, and one that is the start of the other, leave an empty completion; both empty
    leave an empty prompt.  Long texts are written whole.  Columns of the given table with one of the six names are replaced.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    chosen, rejected = (F.coalesce(F.col(c), none) for c in ("chosen", "rejected"))
    equal = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(equal, F.lit(False)).cast("int")
    shared = F.when(first > 0, first - 1).otherwise(F.size(equal))
    rows = pairs.withColumn("prompt_turns", shared)
    after = [F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(0))) for c in (chosen, rejected)]
    return rows.withColumns(
        {
            "prompt": _text(F.slice(chosen, F.lit(1), F.col("prompt_turns"))),
            "chosen_text": _text(after[0]),
            "rejected_text": _text(after[1]),
            "chosen_spans": _spans(after[0]),
            "rejected_spans": _spans(after[1]),
        }
    )


def next_with_key(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(key, id)`` with ``next_id``, the next larger id of the same key, null at the last; ids are numbers.

    Ids are cut into blocks and followed within a block; the last of a block goes on to the first of the next
    block that has any.  So a key with very many rows is dealt over many tasks.
    """
    cut = rows.withColumn("block", F.floor(F.col("id") / block))
    inner = Window.partitionBy("key", "block").orderBy("id")
    cut = cut.withColumn("follows", F.lead("id").over(inner))
    heads = rows.withColumn("block", F.floor(F.col("id") / block)).groupBy("key", "block").agg(F.min("id").alias("head"))
    after = heads.withColumn("next_head", F.lead("head").over(Window.partitionBy("key").orderBy("block"))).drop("head")
    return cut.join(after, ["key", "block"]).select("key", "id", F.coalesce("follows", "next_head").alias("next_id"))


def _stale(turns: Column) -> Column:
    """The turns with the last trained one answered by the trained one before it, or by nothing where there is none."""
    places = F.filter(F.transform(turns, lambda t, i: F.when(t["role"].isin(*TRAINED), i)), lambda i: i.isNotNull())
    last, before = F.try_element_at(places, F.lit(-1)), F.try_element_at(places, F.lit(-2))
    text = F.coalesce(F.get(turns, before)["text"], F.lit(""))
    return F.transform(turns, lambda t, i: F.struct(t["role"].alias("role"), F.when(i == last, text).otherwise(t["text"]).alias("text")))


def paired(turns: DataFrame) -> DataFrame:
    """``(conv_id, rejected_id, chosen, rejected)``: every conversation as the chosen one of a pair.

    The rejected one is the next conversation (by id) that opens with the same turn.  Where none follows,
    it is the conversation itself with its last answer replaced by its answer before, or by an empty one, and
    ``rejected_id`` is null.
    """
    whole = conversations(turns)
    keyed = whole.select(F.xxhash64(F.col("turns")[0]).alias("key"), F.col("conv_id").alias("id"))
    follow = next_with_key(keyed).filter("next_id IS NOT NULL").select("id", "next_id")
    other = whole.select(F.col("conv_id").alias("next_id"), F.col("turns").alias("other"))
    found = follow.join(other, "next_id").withColumnRenamed("id", "conv_id")
    same = F.col("turns")[0].eqNullSafe(F.col("other")[0])  # equal hashes of different turns are no pair
    return whole.join(found, "conv_id", "left").select(
        "conv_id",
        F.when(same, F.col("next_id")).alias("rejected_id"),
        F.col("turns").alias("chosen"),
        F.when(same, F.col("other")).otherwise(_stale(F.col("turns"))).alias("rejected"),
    )
