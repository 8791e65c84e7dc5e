"""Quality rules on words and on lines that many documents of a host share.  DataFrame functions only.

Lines are normalised and hashed; each host's documents with a line are counted, and lines in more of them
than the limit are removed.  A document that loses too many of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.llm.scratch import unused, written

# What counts as a word and as a symbol
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT = 50  # percent of the words in repeated windows
HOST_SHARE = 0.02  # of a host's documents
HOST_FLOOR = 20  # documents; for hosts with few
SMALL_SHARE = 0.1  # of the documents of a host so small that this is less than the floor
LEAST_FLOOR = 3  # documents; for the smallest hosts
MIN_LEFT = 0.5  # of a document's words



def _hashes(words: Column) -> Column:
    """64-bit hashes of all windows of three words."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]))


def _repeated(packed: Column, words: Column, bits: Column) -> Column:
    """Places of windows that have an equal one beside them in the sorted list, equal in hash and in words."""
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

    def place(value: Column) -> Column:
        return value.bitwiseAND(mask).cast("int")

    def same(one: Column, other: Column) -> Column:
        equal = F.call_function("shiftright", one, bits) == F.call_function("shiftright", other, bits)
        for k in range(3):
            equal = equal & (words[place(one) + k] == words[place(other) + k])
        return equal

    def twice(value: Column, i: Column) -> Column:
        return ((i > 0) & same(value, packed[i - 1])) | ((i < F.size(packed) - 1) & same(value, packed[i + 1]))

    return F.transform(F.filter(packed, twice), place)


def _host(docs: DataFrame) -> Column:
    return F.coalesce(docs["source"].cast("string"), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _blank(line: Column) -> Column:
    return F.length(F.translate(line, SPACES, "")) == 0


def _normal(line: Column) -> Column:
    return F.lower(F.array_join(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)), " "))


def measured(docs: DataFrame) -> DataFrame:
    """One row for each row of ``(doc_id, text, source)`` with word counts, line hashes and the hash of the text.

    Windows are found twice by sorting numbers that hold a window's hash above its place, so that equal ones
    meet; the place takes as many bits as the document's number of words needs.
    ``lines`` has the hash and the words of each normalised line; ``sketch``, the text's hash, says which rows are
    one document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), _host(docs).alias("host"))
    base = base.withColumn("row", F.monotonically_increasing_id())
    base = base.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    base = base.withColumn("raw_lines", F.filter(_lines(F.col("text")), lambda x: ~_blank(x)))
    base = base.withColumn("windows", _hashes(F.col("words"))).withColumn("bits", F.length(F.bin(F.size("words"))))
    packed = F.transform("windows", lambda h, i: F.call_function("shiftleft", h, F.col("bits")).bitwiseOR(i.cast("bigint")))
    base = base.withColumn("packed", F.sort_array(packed))
    base = base.withColumn("places", F.sort_array(_repeated(F.col("packed"), F.col("words"), F.col("bits"))))
    steps = F.transform(F.slice("places", 2, F.greatest(F.size("places") - 1, F.lit(0))), lambda p, i: F.least(p - F.col("places")[i], F.lit(3)))
    covered = F.when(F.size("places") > 0, F.aggregate(steps, F.lit(3), lambda total, step: total + step)).otherwise(0)
    normal = F.transform("raw_lines", _normal)
    pairs = F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("hash"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("words")))
    return base.select(
        "row",
        "doc_id",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        F.xxhash64("text").alias("sketch"),
        pairs.alias("lines"),
    )


def frequent_lines(rows: DataFrame, share: float = HOST_SHARE, floor: int = HOST_FLOOR) -> DataFrame:
    """``(host, hash)`` of lines in more than ``floor`` and more than ``share`` of a host's distinct documents.

    Where ``SMALL_SHARE`` of the host is less than ``floor`` it takes its place, down to ``LEAST_FLOOR`` documents.
    A host with no more distinct documents than that loses no line.

    Documents are distinct by their whole text: exact copies are one document and are left to deduplication.
    Texts that differ at all count each, however much they share, so near copies do too.
    """
    seen = rows.select("host", "sketch", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    counts = seen.distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > min(floor, LEAST_FLOOR))
    hosts = rows.select("host", "sketch").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    small = F.least(F.lit(floor), F.greatest(F.lit(LEAST_FLOOR), F.col("docs") * F.lit(SMALL_SHARE)))
    return counts.join(hosts, "host").filter(F.col("n") > F.greatest(F.col("docs") * F.lit(share), small)).select("host", "hash")


def _judged(docs: DataFrame, share: float, floor: int, min_left: float) -> DataFrame:
    """What ``quality`` returns, with the host and the hashes of the document's lines that are too frequent (``gone``)."""
    rows = written(measured(docs), "measured")
    frequent = written(frequent_lines(rows, share, floor), "frequent-lines")
    lines = rows.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.hash", "line.words")
    lost = lines.join(frequent, ["host", "hash"]).groupBy("row").agg(F.sum("words").cast("bigint").alias("removed_words"), F.collect_set("hash").alias("gone"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0).cast("bigint"))
    left = F.col("n_words") - removed >= F.col("n_words") * F.lit(min_left)
    return rows.join(lost, "row", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & left).alias("kept"),
        removed.alias("removed_words"),
        F.col("sketch").alias("text_hash"),
        "host",
        "gone",
    )


def quality(docs: DataFrame, share: float = HOST_SHARE, floor: int = HOST_FLOOR, min_left: float = MIN_LEFT) -> DataFrame:
    """Word counts and verdict of every row of ``(doc_id, text, source)``.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words,
    text_hash)``.  ``kept`` is false where ``base_failed`` is, and where the lines that are too frequent for the
    host (``source``) hold so many of the words that less than ``min_left`` of them remain.

    A null text is an empty one and fails the base; a null source is a host of its own, as an empty one.  Repeated rows
    and null ids are judged row by row.  Long texts, words and lines are judged whole.  An empty table gives no rows; other
    columns are ignored.
    """
    return _judged(docs, share, floor, min_left).drop("host", "gone")


def keep_quality(docs: DataFrame, share: float = HOST_SHARE, floor: int = HOST_FLOOR, min_left: float = MIN_LEFT) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns, and their texts without the lines too frequent for the host.

    The other lines stay as they are, in their order, and so do blank ones.  Where a text has lost lines, ``n_chars``
    (if there is such a column) is the length of what is left.

    Rows are matched by ``doc_id``, host and hash of the text, nulls included, as such rows have equal verdicts.
    """
    key = [unused(docs, c) for c in ("kept_id", "kept_text", "kept_host")]
    gone = unused(docs, "gone")
    kept = _judged(docs, share, floor, min_left).filter("kept")
    kept = kept.select(*[F.col(c).alias(k) for c, k in zip(("doc_id", "text_hash", "host"), key, strict=True)], F.col("gone").alias(gone)).dropDuplicates(key)
    own = (docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit(""))), _host(docs))
    same = own[0].eqNullSafe(kept[key[0]]) & (own[1] == kept[key[1]]) & (own[2] == kept[key[2]])
    text = F.array_join(F.filter(_lines(docs["text"]), lambda x: _blank(x) | ~F.array_contains(kept[gone], F.xxhash64(_normal(x)))), "\n")
    columns = {"text": F.when(kept[gone].isNull(), docs["text"]).otherwise(text)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(kept[gone].isNull(), docs["n_chars"]).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
    return docs.join(kept, same).select(*[columns[c].alias(c) if c in columns else docs[c] for c in docs.columns])
