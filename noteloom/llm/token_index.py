"""Token ids in raw binary shards with a minimal perfect hash index.

A shard file is written front to back: the ids of its documents, then the index, then a fixed footer.  The
index maps a document key to its place by a minimal perfect hash: keys are hashed into a bit array, those alone on
their bit are settled, the others go on to the next, smaller array; the rank of a key's bit is its slot.
A slot holds a fingerprint of the key, to tell absent keys, and the document's first row.  Shards follow each other in the
order of keys; documents without a key come first and are in no index.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from noteloom.llm.scratch import fresh, opened_store, written
from noteloom.llm.words import word_encoder

END = 0
MAGIC = b"NLTOKEN2"
FOOTER = "<8s7Q"  # magic, bytes of an id, ids, rows, rows without a key, keys, where the index begins, levels
SPREAD = 1.5  # bits of a level for each key left
READ_IDS = 1 << 22  # ids read at once
NO_ID = -(1 << 63)
ENCODED = "doc_id bigint, hash bigint, row bigint, range int, ids binary"
MANIFEST = "path string, first_id bigint, first_hash bigint, first_row bigint, n_rows bigint, n_ids bigint"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes: each round multiplies and folds the high bits down."""
    x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Maps n distinct 64-bit keys onto 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        totals = [int(x.sum()) for x in levels]
        self.ranks = [np.cumsum(x) - x + before for x, before in zip(levels, np.cumsum([0, *totals])[:-1], strict=True)]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            size = max(64, int(len(keys) * SPREAD))
            places = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[places]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that is not one of the n, some slot or -1."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for number, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            places = (mixed(keys[left], number) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places]
            found[left[hit]] = ranks[places[hit]]
            left = left[~hit]
        return found


def _index(keys: np.ndarray, sizes: np.ndarray, blank: int) -> tuple[bytes, int, int]:
    """The index of sorted row keys and their numbers of ids; how many keys and levels it has.  The first ``blank`` rows have no key."""
    distinct, first = np.unique(keys[blank:], return_index=True)
    hashed = PerfectHash.of(distinct)
    slots = hashed.slots(distinct)
    prints, rows = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u8")
    prints[slots], rows[slots] = fingerprint(distinct), first + blank
    parts = [struct.pack("<Q", len(x)) + np.packbits(x).tobytes() for x in hashed.levels]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype("<u8")
    return b"".join([*parts, prints.tobytes(), rows.tobytes(), keys.astype("<i8").tobytes(), offsets.tobytes()]), len(distinct), len(hashed.levels)


class TokenShard:
    """A shard file opened for keyed reads; ``source`` is an open file that can seek."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        size = source.size()
        source.seek(size - struct.calcsize(FOOTER))
        magic, width, self.n_ids, self.n_rows, self.blank, n_keys, begin, n_levels = struct.unpack(FOOTER, source.read(struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.kind = np.dtype(f"<u{width}")
        source.seek(begin)
        data, at, levels = source.read(size - struct.calcsize(FOOTER) - begin), 0, []
        for _ in range(n_levels):
            (bits,) = struct.unpack_from("<Q", data, at)
            length = (bits + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at + 8), count=bits).astype(bool))
            at += 8 + length
        self.hash = PerfectHash(levels)
        self.prints = np.frombuffer(data, "<u4", n_keys, at)
        self.first = np.frombuffer(data, "<u8", n_keys, at + 4 * n_keys).astype(np.int64)
        at += 12 * n_keys
        self.keys = np.frombuffer(data, "<i8", self.n_rows, at)
        self.offsets = np.frombuffer(data, "<u8", self.n_rows + 1, at + 8 * self.n_rows).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 for keys that the shard does not have."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprint(keys[known])
        found = np.full(len(keys), -1, np.int64)
        found[known] = self.first[slots[known]]
        return found

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of the rows from ``first`` up to ``last``, without it."""
        begin, end = self.offsets[first], self.offsets[last]
        self.source.seek(int(begin) * self.kind.itemsize)
        return np.frombuffer(self.source.read(int(end - begin) * self.kind.itemsize), self.kind)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key; none if there is no such document."""
        (row,) = self.rows(np.array([key], np.int64))
        found = []
        while 0 <= row < self.n_rows and self.keys[row] == key:
            found.append(self.ids(row, row + 1))
            row += 1
        return found


def ranges(docs: DataFrame, count: int) -> np.ndarray:
    """Ids between ``count`` ranges of about as many rows each; one that fills several ranges is met as often.

    One pass over the ids alone.  A missing id counts as the smallest number.
    """
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    ids = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    cuts = docs.agg(F.percentile_approx(ids, shares, max(10_000, 10 * count))).first()[0] if count > 1 else None
    return np.array(cuts or [], np.int64)


def encoded_rows(docs: DataFrame, vocabulary: str, cuts: np.ndarray, byte_level: bool = True, end: int = END) -> DataFrame:
    """``(doc_id, hash, row, range, ids)`` of every row of ``(doc_id, text)``: a shuffle of it moves ids and no text.

    ``hash`` is the text's, ``row`` a number of its own, ``range`` the place of the id among ``cuts``: one of several for an id that
    is met there more than once.  ``ids``, closed by ``end``, take two bytes each if all numbers of the vocabulary do, else four.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = word_encoder(vocabulary, byte_level), TaskContext.get().partitionId() << 33
        kind = _kind(encoder.tokenizer.get_vocab_size(), end)
        for batch in batches:
            for rows, flat, lengths in encoder.encode(batch.column(1)):
                bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
                out = np.full(bounds[-1], end, kind)
                own = np.ones(len(out), bool)
                own[bounds[1:] - 1] = False
                out[own] = flat
                ids = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(bounds * kind.itemsize), pa.py_buffer(out)])
                doc_id, text_hash = (batch.column(c).slice(rows.start, len(lengths)) for c in (0, 2))
                numbers = np.arange(row, row + len(lengths))
                row += len(lengths)
                known = doc_id.fill_null(NO_ID).to_numpy()
                first = np.searchsorted(cuts, known, "left")
                several = np.searchsorted(cuts, known, "right") - first + 1
                place = first + (mixed(numbers, 0) % several.astype(np.uint64)).astype(np.int64)
                columns = [doc_id, text_hash, pa.array(numbers), pa.array(place.astype(np.int32)), ids.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "row", "range", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    return rows.mapInArrow(run, ENCODED)


def _kind(vocabulary: int, end: int) -> np.dtype:
    return np.dtype("<u2" if max(vocabulary, end + 1) <= 1 << 16 else "<u4")


def write_shards(docs: DataFrame, vocabulary: str, folder: str, byte_level: bool = True, end: int = END) -> DataFrame:
    """Encode ``(doc_id, text)`` and write the shards to ``folder``; returns the written manifest, one row a shard.

    ``end`` closes each document.  Every attempt of a task writes a file of its own, and the manifest names the one of the attempt
    that counted.  Rows without ``doc_id`` come first; they have no key, so only ``read_shards`` gives them.  Rows that
    repeat a ``doc_id`` are kept in the order of their texts' hashes; they may be many, and go to as many shards as they need.
    Null texts are empty, long ones whole: a document is encoded in one task.  Other columns are ignored, and an empty
    table has no shards.  ``folder`` is a URI that executors reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(word_encoder(vocabulary, byte_level).tokenizer.get_vocab_size(), end)
        store, root = opened_store(folder)
        keys, sizes, first, sink, total, blank = [], [], None, None, 0, 0
        path = f"shard-{uuid.uuid4().hex}.tok"
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(f"{root}/{path}", compression=None)
                first = [batch.column(c)[0].as_py() for c in range(3)]
            blank += batch.column(0).null_count
            keys.append(batch.column(0).fill_null(0).to_numpy())
            ids = batch.column(4).to_pylist()
            sink.write(b"".join(ids))
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)) // kind.itemsize)
            total += int(sizes[-1].sum())
        if sink is None:
            return
        keys, sizes = np.concatenate(keys), np.concatenate(sizes)
        index, n_keys, levels = _index(keys, sizes, blank)
        sink.write(index)
        sink.write(struct.pack(FOOTER, MAGIC, kind.itemsize, total, len(keys), blank, n_keys, total * kind.itemsize, levels))
        sink.close()
        row = [f"{folder}/{path}", *first, len(keys), total]
        fields = ["path", "first_id", "first_hash", "first_row", "n_rows", "n_ids"]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if c == "path" else pa.int64()) for c, x in zip(fields, row, strict=True)], fields)

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = encoded_rows(docs, vocabulary, ranges(docs, tasks), byte_level, end)
    order = ["doc_id", "hash", "row"]  # nulls first
    return written(encoded.repartitionById(tasks, "range").sortWithinPartitions(*order).mapInArrow(run, MANIFEST), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, by keyed access to the shards of a manifest.

    ``start`` counts the ids of all documents before, over all shards; ``ids`` are little-endian unsigned 32-bit
    numbers.  Each shard's keys are looked up in its index, and rows without a key are those before the first of them;
    payloads are read some documents at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = opened_store(row["path"])
                with store.open_input_file(path) as source:
                    shard = TokenShard(source)
                    distinct = np.unique(shard.keys[shard.blank :])
                    begins = shard.rows(distinct)
                    if (begins < shard.blank).any() or (shard.keys[begins] != distinct).any():
                        raise ValueError(f"the index of {row['path']} does not find its keys")
                    # first and last row of groups of rows that are read at once, however many of them share a key
                    groups = shard.offsets[:-1] // READ_IDS
                    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist()]
                    for first, last in zip(cuts, [*cuts[1:], shard.n_rows], strict=True):
                        ids = shard.ids(first, last).astype("<u4")
                        offsets = shard.offsets[first : last + 1]
                        bounds = (offsets - offsets[0]).tolist()
                        data = [ids[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
                        keys = pa.array(shard.keys[first:last], mask=np.arange(first, last) < shard.blank)
                        columns = [keys, pa.array(offsets[:-1] + row["base"]), pa.array(np.diff(offsets)), pa.array(data, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    before = Window.orderBy("first_id", "first_hash", "first_row").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def encode_to_shards(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the shards of ``docs`` to a new shared folder and read them back."""
    return read_shards(write_shards(docs, vocabulary, fresh(docs.sparkSession, "token-shards")))
