"""Alignment of the tokens of two vocabularies over the same bytes, by merge path.

Both token sequences of a text end tokens at byte offsets.  Merging the two sorted lists of ends (A before B where they are
equal) meets every overlap: each step to a new offset closes a stretch of bytes that lies in one token of either side.  Where
an A end and a B end fall together a group closes.  The merge of all texts in hand is one path through a grid; diagonals at
equal distances cut it, a binary search on each finds where, and so every piece has the same number of steps
however long the texts and tokens are.  Pieces need nothing of each other but the one end before them.  Groups that reach
over the borders of pieces are stitched from the closing ends.

Two tables follow from the links: how often each pair of ids is linked in the whole corpus, and from it scores of
each document.  Pairs met in a large share of the rows are few and are sent to all tasks; the others are joined by a
shuffle, in which none of them can be large.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from noteloom.llm.scratch import written
from noteloom.llm.words import Remembered, WordEncoder, byte_letters, parts, put_back, sliced, take_ranges, word_encoder

STEPS = 1 << 14  # ends merged by a piece
PART_BYTES = 1 << 20  # text aligned at once; some hundred times as much is in hand meanwhile
HOT_PAIRS = 1 << 16  # a pair in more than one of so many (document, pair) rows is sent to all tasks: there are fewer than that
BLANK = "▁"
SPACED = re.compile(" +[^ ]*")
ALIGNED = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, a array<int>, b array<int>, times array<int>"


class PieceEncoder(WordEncoder):
    """Encodes arrays of texts as a sentence piece model with a leading space does.

    No piece of the vocabulary has a blank after another letter, so no token reaches over a cut before a space; a vocabulary
    for which that is not so is refused.
    """

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.pieces):
            raise ValueError("tokens of this vocabulary reach over words")
        self.alone = array("I", [self.model.piece_to_id(BLANK)]).tobytes()
        self.known = Remembered()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that begin with a space, the one that the model adds."""
        found = self.known.find(chunks)
        missing = [i for i, x in enumerate(found) if x is None]
        at = iter(missing)
        for texts in sliced([chunks[i][1:] for i in missing]):
            for text, ids in zip(texts, self.model.encode(texts, num_threads=1), strict=True):
                found[next(at)] = array("I", ids).tobytes() if text else self.alone
        self.known.add([chunks[i] for i in missing], [found[i] for i in missing])
        return found

    def part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each text, which begins with the space that the model adds."""
        odd = pc.match_substring(texts, "  ").to_numpy(zero_copy_only=False)
        pieces = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        # what stands before the first space is empty
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        values, own = pieces.flatten(), np.ones(int(counts.sum()), bool)
        own[np.cumsum(counts) - counts] = False
        flat, sizes = self._gathered(values.filter(pa.array(own)), np.zeros(int(own.sum()), bool), counts - 1)
        if not odd.any():
            return flat, sizes
        return put_back(odd, (flat, sizes), self.cut_by(SPACED, texts.filter(pa.array(odd))))


class Spelling:
    """The bytes of every token of a vocabulary, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        return take_ranges(self.letters, self.starts[ids], self.sizes[ids])

    @classmethod
    def of_byte_letters(cls, vocabulary: dict[str, int]) -> Spelling:
        """Tokens written with a letter for each byte; others, special ones, are spelt as they are."""
        back = {chr(letter): byte for byte, letter in byte_letters().items()}
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            tokens[number] = bytes([back[x] for x in token]) if all(x in back for x in token) else token.encode()
        return cls(tokens)

    @classmethod
    def of_pieces(cls, pieces: list[str]) -> Spelling:
        """Pieces as text, with their blank as a space and ``<0x..>`` as a byte."""
        own_byte = re.compile("<0x([0-9A-F]{2})>")
        return cls([bytes([int(m[1], 16)]) if (m := own_byte.fullmatch(p)) else p.replace(BLANK, " ").encode() for p in pieces])


class Piece(NamedTuple):
    """What a piece of the merge emits: linked tokens by their numbers, and the last tokens of the groups that close in it."""

    link_a: np.ndarray
    link_b: np.ndarray
    close_a: np.ndarray
    close_b: np.ndarray


def cut_path(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ends of ``a`` and of ``b`` before each diagonal of their merge, ``steps`` apart, the last one included."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (going := low < high).any():
        middle = (low[going] + high[going]) // 2
        # an A end that is not over the B end it competes with comes before it
        first = a[middle] <= b[diagonal[going] - middle - 1]
        low[going] = np.where(first, middle + 1, low[going])
        high[going] = np.where(first, high[going], middle)
    return low, diagonal - low


def merged_piece(a: np.ndarray, b: np.ndarray, a_from: int, a_to: int, b_from: int, b_to: int) -> Piece:
    """The steps of the merge between two cuts; of what other pieces hold only the end before ``a_from`` is looked at."""
    own_a, own_b = a[a_from:a_to], b[b_from:b_to]
    over_a = b_from + np.searchsorted(own_b, own_a, "left")  # the B token that holds the bytes before each A end
    over_b = a_from + np.searchsorted(own_a, own_b, "right")
    numbers = np.arange(b_from, b_to)
    closing = (over_b > 0) & (a[over_b - 1] == own_b) if len(a) else np.zeros(len(own_b), bool)
    link_a = np.concatenate((np.arange(a_from, a_to), over_b[~closing]))
    link_b = np.concatenate((over_a, numbers[~closing]))
    return Piece(link_a, link_b, over_b[closing] - 1, numbers[closing])


def merged(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> Piece:
    """All links and closing ends of two lists of ends whose last ends are equal; pieces are merged one by one."""
    in_a, in_b = (x.tolist() for x in cut_path(a, b, steps))
    made = [merged_piece(a, b, *own_a, *own_b) for own_a, own_b in zip(pairwise(in_a), pairwise(in_b), strict=True)]
    return Piece(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*made, strict=True)) or [()] * 4)))


class Numerals:
    """Decimal ids, each with room for the mark after it."""

    def __init__(self, size: int):
        texts = [b"%d," % i for i in range(size)]
        self.sizes = np.fromiter(map(len, texts), np.int64, size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(texts), np.uint8)

    def written(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids with these marks, and where each ends."""
        out = take_ranges(self.letters, self.starts[ids], self.sizes[ids])
        ends = np.cumsum(self.sizes[ids])
        out[ends - 1] = marks
        return out, ends


def stitched(close_a: np.ndarray, close_b: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids group by group, A before B, whether each is of B, and the place after each group's last id.

    A group goes from the closing before it to its own, whichever pieces these were met in.
    """
    of_a, of_b = (np.diff(np.concatenate(([-1], x))) for x in (close_a, close_b))
    ends = np.cumsum(of_a + of_b)
    side = np.repeat(np.tile([False, True], len(close_a)), np.stack((of_a, of_b), 1).ravel())
    ids = np.empty(len(side), np.int64)
    ids[~side], ids[side] = a_ids, b_ids
    return ids, side, ends


class Aligner:
    """Aligns texts by a byte-level vocabulary (A) and a sentence piece model (B)."""

    def __init__(self, a_path: str, b_path: str, steps: int = STEPS):
        self.a, self.b, self.steps = word_encoder(a_path, True, plain=True), PieceEncoder(b_path), steps
        self.a_spelling = Spelling.of_byte_letters(self.a.tokenizer.get_vocab(with_added_tokens=True))
        self.b_spelling = Spelling.of_pieces(self.b.pieces)
        self.width = len(self.b.pieces)
        self.numerals = Numerals(max(len(self.a_spelling.sizes), self.width))

    def _tokens(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Ids and their numbers, A and B; texts that are not what their tokens spell have none."""
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        spelt = np.frombuffer(b"".join(spaced.cast(pa.large_binary()).to_pylist()), np.uint8)
        lengths = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
        right, both = ~empty, []
        for encoder, spelling in ((self.a, self.a_spelling), (self.b, self.b_spelling)):
            ids, counts = encoder.part(spaced)
            ids = ids.astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            fits = np.bincount(row, spelling.sizes[ids], len(counts)).astype(np.int64) == lengths
            # bytes are compared where their numbers are equal
            where = np.cumsum(lengths) - lengths
            wanted = take_ranges(spelt, where[fits], lengths[fits])
            differs = spelling.spelt(ids[fits[row]]) != wanted
            fits[np.repeat(np.flatnonzero(fits), lengths[fits])[differs]] = False
            right &= fits
            both.append((ids, counts, row))
        return tuple(x for ids, counts, row in both for x in (ids[right[row]], np.where(right, counts, 0)))

    def align(self, texts: pa.Array, digest: bool) -> dict[str, pa.Array]:
        """The columns of ``ALIGNED`` but the first two, of texts without nulls."""
        n = len(texts)
        a_ids, a_counts, b_ids, b_counts = self._tokens(texts)
        a_row, b_row = (np.repeat(np.arange(n), x) for x in (a_counts, b_counts))
        all_of = merged(np.cumsum(self.a_spelling.sizes[a_ids]), np.cumsum(self.b_spelling.sizes[b_ids]), self.steps)
        link_row = a_row[all_of.link_a]
        n_links, n_groups = np.bincount(link_row, minlength=n), np.bincount(b_row[all_of.close_b], minlength=n)
        # equal pairs of a text are counted
        pairs = (link_row * len(self.a_spelling.sizes) + a_ids[all_of.link_a]) * self.width + b_ids[all_of.link_b]
        pairs, times = np.unique(pairs, return_counts=True)
        pair_row, pairs = np.divmod(pairs, len(self.a_spelling.sizes) * self.width)
        offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(pair_row, minlength=n)))).astype(np.int32))
        a, b = np.divmod(pairs, self.width)
        columns = {"n_a": a_counts, "n_b": b_counts, "n_groups": n_groups, "n_links": n_links}
        out = {name: pa.array(x.astype(np.int64)) for name, x in columns.items()}
        out["groups"] = pa.array(self._groups(all_of, a_ids, b_ids, a_counts + b_counts, digest), pa.string())
        return out | {name: pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for name, x in (("a", a), ("b", b), ("times", times))}

    def _groups(self, all_of: Piece, a_ids: np.ndarray, b_ids: np.ndarray, counts: np.ndarray, digest: bool) -> list[str]:
        """Each text's groups, as ``a1,a2|b1;a3|b2,b3`` or the SHA-256 of that; empty for texts without tokens."""
        ids, side, ends = stitched(all_of.close_a, all_of.close_b, a_ids, b_ids)
        marks = np.full(len(ids), ord(","), np.uint8)
        marks[:-1][~side[:-1] & side[1:]] = ord("|")
        marks[ends - 1] = ord(";")
        letters, stops = self.numerals.written(ids, marks)
        bounds = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        data = letters.tobytes()
        texts = (data[s : max(s, e - 1)] for s, e in pairwise(bounds))  # without the last mark
        return [hashlib.sha256(t).hexdigest() if digest and t else t.decode() for t in texts]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str, steps: int = STEPS) -> Aligner:
    """One for each worker process, so that what its encoders remember serves all its tasks."""
    return Aligner(a_path, b_path, steps)


def aligned(docs: DataFrame, a_path: str, b_path: str, digest: bool = False, steps: int = STEPS) -> DataFrame:
    """The alignment of every row of ``(doc_id, text)``: token, group and link numbers, the groups of ids, and its
    linked id pairs with their times.

    A encodes a space and the text by a byte-level vocabulary file, B the text by a sentence piece model that adds the space;
    strings of special tokens are plain text.  ``groups`` is ``a1,a2|b1;a3|b2,b3``, with ``digest`` its SHA-256 in hex.  ``row`` is a
    number of the row's own, so write the result before it is used twice.  Texts that are null, empty or not spelt by their
    tokens byte for byte have no tokens, zeros and empty groups.  Repeated rows and null ids are rows as any other; other columns are
    ignored, and an empty table gives no rows.  A text is encoded whole by one task, and long ones are merged in as many
    pieces as they need.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, row = aligner(a_path, b_path, steps), TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            for rows in parts(texts, PART_BYTES):
                n = rows.stop - rows.start
                columns = {"row": pa.array(np.arange(row, row + n)), "doc_id": batch.column(0).slice(rows.start, n)}
                columns |= made.align(texts.slice(rows.start, n), digest)
                row += n
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, ALIGNED)


def links(rows: DataFrame) -> DataFrame:
    """``(row, a, b, times)``: the linked id pairs of written rows of ``aligned``."""
    return rows.select("row", F.inline(F.arrays_zip("a", "b", "times")))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(a, b, n, n_rows, best)`` of every linked id pair of the corpus, written.

    ``n`` counts links and ``n_rows`` the documents with one; ``best`` says that no pair of the same B id has more links.
    The table of the highest count of each B id is sent to all tasks: it has a row for each id of B's vocabulary at most.
    """
    counts = written(links(rows).groupBy("a", "b").agg(F.sum("times").alias("n"), F.count("*").alias("n_rows")), "pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    marked = counts.join(F.broadcast(highest), "b").withColumn("best", F.col("n") == F.col("highest"))
    return written(marked.select("a", "b", "n", "n_rows", "best"), "pairs-best")


def scored(rows: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Written rows of ``aligned`` with ``n_best``, the links whose pair is a best one, and ``count_sum``, the counts of all
    links' pairs added up.

    Pairs that are more than one in ``hot_pairs`` of all (document, pair) rows are fewer than that, and are sent to all tasks; of
    the others none has a larger share of the shuffle that joins them.
    """
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("n_rows") * hot_pairs > total).select("a", "b", "n", "best"))
    cold = counts.filter(F.col("n_rows") * hot_pairs <= total).select("a", "b", "n", "best")
    pairs = links(rows)
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    near = pairs.join(hot, ["a", "b"]).groupBy("row").agg(*sums)
    far = pairs.join(hot, ["a", "b"], "left_anti").join(cold.hint("shuffle_hash"), ["a", "b"]).groupBy("row").agg(*sums)
    both = near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = rows.drop("a", "b", "times").join(both, "row", "left")
    return whole.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_best", "count_sum")})
