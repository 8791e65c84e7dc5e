"""Near-duplicates by SimHash, found by fuzzy hashing with the binary Golay code.

Fingerprints of 64 bits link when at most four bits differ.  They are cut into three segments of
22, 21 and 21 bits.  The perfect Golay code of length 23 maps every word to the one codeword within
distance three.  The *nearby indices* of a segment are the codewords of the segment itself and of all
words one bit away, one to six different numbers of 12 bits; two segments that differ in at most two
bits share one of them, the one of a word between them.

By pigeonhole, four errors over three segments leave either a segment without error, and then another
with at most two, or two segments with exactly one error each and a third with at most two:

* six keys families pair a whole segment with the nearby indices of another;
* three families pair a half of one segment, a half of a second (one error leaves a half whole), and
  the nearby indices of the third.

So every link shares a key of 33 bits or more, and few other pairs do.  Fingerprints that share a key
are verified on their 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.llm.components import components
from noteloom.llm.scratch import unused, written

# Bits of the three segments, lowest first, and the generator of the Golay code
SEGMENTS = (22, 21, 21)
GENERATOR = 0xC75
LENGTH, PARITY = 23, 11

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) text: a bit is set if over half of the shingles' XXH64 have it.

    Fewer words than a shingle make one shingle of them all; no words, or no text, give zero.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: max(1, len(tokens) - words + 1)].tolist(), ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(first)
    for at in range(0, total, BLOCK):
        part = slice(at, at + BLOCK)
        hashes = np.array([digest(line[s:e], SEED) for s, e in zip(first[part], last[part], strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def _text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash")


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, text_hash)`` with the 64 bits as a signed number; one row for each row of ``(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64)), batch.column(2)], ["doc_id", "fp", "text_hash"])

    return docs.select(F.col("doc_id").cast("bigint"), "text", _text_hash(docs)).mapInArrow(run, "doc_id bigint, fp bigint, text_hash bigint")


def _remainder(word: int) -> int:
    for at in range(LENGTH - 1, PARITY - 1, -1):
        if word >> at & 1:
            word ^= GENERATOR << (at - PARITY)
    return word


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and the error of each remainder."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int64)
    errors = np.zeros(1 << PARITY, np.int64)
    for weight in range(4):
        for places in combinations(range(LENGTH), weight):
            word = sum(1 << p for p in places)
            errors[_remainder(word)] = word
    return low, high, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit number of the codeword within distance three of each 23-bit word."""
    low, high, errors = _golay()
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> PARITY


def nearby_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and codeword indices: those of the words and of all words one bit away, each once."""
    flips = np.array([0, *(1 << b for b in range(bits))], np.int64)
    found = np.sort(codeword_index(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(fresh)[0], found[fresh]


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of unsigned fingerprints; the family of a key is in its bits from 40 on."""
    parts, shift = [], 0
    for bits in SEGMENTS:
        parts.append((fps >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1))
        shift += bits
    near = [nearby_indices(p, b) for p, b in zip(parts, SEGMENTS, strict=True)]
    rows, keys, family = [], [], 0
    for whole, fuzzy in permutations(range(3), 2):
        at, index = near[fuzzy]
        rows.append(at)
        keys.append(family << 40 | parts[whole][at] << 12 | index)
        family += 1
    halves = [(p & 0x7FF, p >> 11) for p in parts]
    for fuzzy in range(3):
        one, two = (i for i in range(3) if i != fuzzy)
        at, index = near[fuzzy]
        for left in halves[one]:
            for right in halves[two]:
                rows.append(at)
                keys.append(family << 40 | left[at] << 23 | right[at] << 12 | index)
                family += 1
    return np.concatenate(rows), np.concatenate(keys)


def linked(fps: np.ndarray, bits: int) -> tuple[list, list]:
    """Links that join all fingerprints of one key that are connected within it: a forest, not all pairs.

    Every fingerprint reached is compared with those not reached yet, so a tight group costs little
    more than one comparison a member.
    """
    rest, left, right = fps, [], []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            one = frontier.pop()
            near = np.bitwise_count(rest ^ one) <= bits
            if near.any():
                found = rest[near]
                left += [one] * len(found)
                right += found.tolist()
                frontier += list(found)
                rest = rest[~near]
    return left, right


def _links(bits: int):
    def batch_of(left: list, right: list) -> pa.RecordBatch:
        arrays = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (left, right)]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key, so the rows of a key follow each other; the last key may go on in the next batch."""
        key, kept = None, []
        for batch in batches:
            keys, fps = (batch.column(i).to_numpy() for i in (0, 1))
            fps = fps.view(np.uint64)
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            left, right = [], []
            if key is not None and keys[0] != key:
                x, y = linked(np.unique(np.concatenate(kept)), bits)
                left, right, kept = left + x, right + y, []
            inner = slice(1, len(starts) - 1)
            sizes = (ends - starts)[inner]
            one = fps[starts[inner][sizes == 2]]
            two = fps[starts[inner][sizes == 2] + 1]
            near = np.bitwise_count(one ^ two) <= bits
            left, right = left + one[near].tolist(), right + two[near].tolist()
            for i in np.flatnonzero(sizes > 2) + 1:
                x, y = linked(np.unique(fps[starts[i] : ends[i]]), bits)
                left += x
                right += y
            if len(starts) > 1:
                x, y = linked(np.unique(np.concatenate([*kept, fps[: ends[0]]])), bits)
                left, right, kept = left + x, right + y, []
            kept.append(fps[starts[-1] :].copy())
            key = keys[-1]
            yield batch_of(left, right)
        if kept:
            yield batch_of(*linked(np.unique(np.concatenate(kept)), bits))

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), 4096):
            part = fps[at : at + 4096]
            rows, keys = fuzzy_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def fingerprint_links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)`` links between the distinct fingerprints of ``(fp)``, enough to connect all that are connected.

    ``bits`` is at most four.  The rows of one key are distinct fingerprints that agree in 33 bits or
    more, whatever the number of documents behind them; a task holds eight bytes for each of one key.
    """
    if not 0 <= bits <= 4:
        raise ValueError("the segments are cut for at most four differing bits")
    keyed = fps.select("fp").mapInArrow(_keys, "key bigint, fp bigint")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(bits), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` of every row of ``(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` that a row reaches over links of at most ``bits`` bits,
    its own included; a row that nothing links to has its own.  Null, empty and blank texts have
    fingerprint zero and link as any other.  Rows with a null ``doc_id`` stay, and count as no
    smallest one; a group of none but such rows has a null component.  Repeated rows are returned as often as given.  Columns beside
    the two are ignored.  An empty table gives no rows.  Long texts are hashed whole, by one task.

    Equal fingerprints are one node, so only distinct ones are keyed and compared.
    """
    return _grouped(docs, words, bits).drop("group", "text_hash")


def _grouped(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """What ``near_duplicates`` returns, with a fingerprint that stands for the group and the hash of the text."""
    hashed = written(fingerprints(docs, words), "fingerprints")
    nodes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    member = written(components(fingerprint_links(nodes, bits)), "members")
    linked_nodes = member.join(nodes, member["node"] == nodes["fp"]).select("node", "root", "least")
    least = linked_nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked_nodes.select("node", "root").join(least, "root").select("node", "root", "component_id")
    label = nodes.join(classes, nodes["fp"] == classes["node"], "left")
    label = written(label.select(F.col("fp").alias("node"), F.coalesce("root", "fp").alias("group"), F.coalesce("component_id", "least").alias("component_id")), "labels")
    named = hashed.join(label, hashed["fp"] == label["node"])
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return named.select("doc_id", "fp", text, "component_id", "group", "text_hash")


def deduplicate(docs: DataFrame, words: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one whose ``doc_id`` names the group.

    Of rows that repeat that ``doc_id`` within the group one of the smallest text hash stays, and so it is in a group of none
    but rows with a null ``doc_id``.  Groups named by the same ``doc_id`` keep a row each: texts that are no near duplicates are
    never lost to an id that repeats.
    """
    found = _grouped(docs, words, bits)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("first"))
    # a text is in one group only, so id and text say which group's row it is
    kept_id, kept_hash = (unused(docs, c) for c in ("kept_id", "kept_hash"))
    kept = first.select(F.col("first.doc_id").alias(kept_id), F.col("first.text_hash").alias(kept_hash))
    own_hash = unused(kept, unused(docs, "own_hash"))
    marked = docs.withColumn(own_hash, _text_hash(docs))
    same = marked["doc_id"].eqNullSafe(kept[kept_id]) & (marked[own_hash] == kept[kept_hash])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own_hash]).drop(own_hash)
