"""Exact top-k by inner product over sparse integer vectors, term at a time.

A vector is a list of (dimension, weight) terms without zeros.  Candidates lie in blocks; a block is turned
into postings, the vectors and weights of each dimension.  Queries add their weights times the postings of their
dimensions into dense arrays with one score for every vector of the block; postings that hold most of the block are
added all at once, as a product of matrices.  The best k of the first arrays are selected by partition; of later
ones only what reaches the k-th best so far is looked at.  Each query's best of all blocks are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from noteloom.llm.scratch import opened_store, written

K = 20
SCALE = 64
EVERY = 20
QUERY_BLOCK = 512  # queries in a block
TOGETHER = 128  # queries whose scores are held at a time
UNIT = 2048  # queries that go through the candidates together, about
BLOCK = 4096  # candidates in a block
TASKS = 4  # tasks for each core, at least, where there are enough files of candidates
SCORES = "query_id bigint, vec_id bigint, score bigint"
BLOCKS = "block bigint, vectors int, ids binary, lengths binary, width int, weights binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, weights)`` of ``(vec_id, embedding)``: floor(scale * x) of each component as a whole number.

    Vectors that are null, or hold a null or a component that is no finite number, and rows without
    ``vec_id``, are left out.  What is beyond 64 bits becomes the largest or smallest number of these.
    """
    most = 2.0**63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
            owner = np.repeat(np.arange(len(sizes)), sizes)
            usable = np.ones(len(sizes), bool)
            usable[owner[~np.isfinite(flat)]] = False
            with np.errstate(over="ignore"):
                whole = np.floor(flat[usable[owner]] * scale)
            large, small = whole >= most, whole < -most
            weights = np.where(large | small, 0, whole).astype(np.int64)
            weights[large], weights[small] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            offsets = np.concatenate(([0], np.cumsum(sizes[usable]))).astype(np.int32)
            ids = batch.column(0).filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(weights))], ["vec_id", "weights"])

    given = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    return given.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id bigint, weights array<bigint>")


def _narrow(weights: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as they all fit."""
    low, high = (int(weights.min()), int(weights.max())) if len(weights) else (0, 0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return weights.astype(kind)


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``(block, vectors, ids, lengths, width, weights)``: vectors packed by ``size``; written, as each block is read many times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(1)
                flat = _narrow(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
                row = [number, part.num_rows, part.column(0).to_numpy().tobytes(), lengths.tobytes(), flat.itemsize, flat.tobytes()]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")])
                number += 1

    return written(rows.mapInArrow(run, BLOCKS), name)


def _terms(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, dimensions and weights of all terms, zeros left out."""
    sizes, flat = np.frombuffer(block["lengths"], np.int32), np.frombuffer(block["weights"], f"i{block['width']}")
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    dimension = np.arange(len(flat)) - np.repeat(start, sizes)
    some = flat != 0
    return row[some], dimension[some], flat[some].astype(np.int64)


def _postings(rows: np.ndarray, dimensions: np.ndarray, weights: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(dimensions, kind="stable")
    found, starts = np.unique(dimensions[order], return_index=True)
    ends = [*starts[1:], len(order)][: len(found)]
    return {int(d): (rows[order[s:e]], weights[order[s:e]]) for d, s, e in zip(found, starts, ends, strict=True)}


def _matrix(n: int, columns: np.ndarray, terms: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The terms of ``n`` vectors in the dimensions ``columns``, which are sorted, as a matrix."""
    rows, dimensions, weights = terms
    out = np.zeros((n, len(columns)), np.int64)
    if len(columns):
        at = np.minimum(np.searchsorted(columns, dimensions), len(columns) - 1)
        there = columns[at] == dimensions
        out[rows[there], at[there]] = weights[there]
    return out


def _most(weights: np.ndarray) -> int:
    return max(abs(int(weights.min())), abs(int(weights.max()))) if len(weights) else 0


def _kind(bound: int) -> type:
    """The numbers in which sums of whole numbers up to ``bound`` are exact, the fastest ones."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


class Held:
    """A block of candidates: the postings that hold at least half of its vectors as a matrix, the others by dimension."""

    def __init__(self, block: dict):
        self.ids = np.frombuffer(block["ids"], np.int64)
        terms = _terms(block)
        self.most = _most(terms[2])
        found, of, counts = np.unique(terms[1], return_inverse=True, return_counts=True) if _wide(terms[1]) else _counted(terms[1])
        full = 2 * counts >= len(self.ids)
        self.columns = found[full]
        few = ~full[of]
        self.postings = _postings(*(x[few] for x in terms))
        self.matrix, self.cast = _matrix(len(self.ids), self.columns, terms), {}

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self.cast:
            self.cast[kind] = self.matrix.astype(kind)
        return self.cast[kind]


def _wide(dimensions: np.ndarray) -> bool:
    return len(dimensions) == 0 or int(dimensions.max()) > 4 * len(dimensions)


def _counted(dimensions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``unique`` gives with inverse and counts, without a sort: for dimensions that are not many more than the terms."""
    counts = np.bincount(dimensions)
    found = np.flatnonzero(counts)
    return found, (np.cumsum(counts > 0) - 1)[dimensions], counts[found]


class Asked:
    """Some queries and their ``k`` best candidates so far, the best first, ties by the smaller id."""

    def __init__(self, ids: np.ndarray, terms: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
        self.ids, self.terms, self.k = ids, terms, k
        self.most, self.width = _most(terms[2]), len(np.unique(terms[1]))
        self.postings = _postings(*terms)
        self.query, self.found, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.full = np.zeros(len(ids), bool)  # the last two hold for these only
        self.limit, self.last = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        self.shape, self.matrix = None, None

    def scores(self, held: Held) -> np.ndarray:
        """A row for each query, a score for each candidate."""
        kind = _kind(self.most * held.most * max(self.width, 1))
        shape = (kind, held.columns.tobytes())
        if shape != self.shape:
            self.shape, self.matrix = shape, _matrix(len(self.ids), held.columns, self.terms).astype(kind)
        out = self.matrix @ held.typed(kind).T
        less, more = sorted((self.postings, held.postings), key=len)
        for d in less:
            if d in more and d in held.postings:
                (asking, times), (rows, weights) = self.postings[d], held.postings[d]
                out[np.ix_(asking, rows)] += times.astype(kind)[:, None] * weights.astype(kind)
        return out

    def meet(self, held: Held) -> None:
        scores, n = self.scores(held), len(held.ids)
        lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
        # a limit beyond what these numbers tell apart is beyond all of these scores too
        limit = np.where(self.full, self.limit.astype(scores.dtype), scores.dtype.type(lowest))
        # a query's own id is left out, however often it comes
        own = np.flatnonzero(np.isin(held.ids, self.ids))
        same = self.ids[:, None] == held.ids[own]
        wanted = self.k + int(same.sum(axis=1).max(initial=0))
        if n > wanted and not self.full.all():
            limit = np.maximum(limit, np.partition(scores, n - wanted, axis=1)[:, n - wanted])
        hit = scores >= limit[:, None]
        hit[:, own] &= ~same
        at = np.flatnonzero(hit)
        query, score, found = at // n, scores.ravel()[at].astype(np.int64), held.ids[at % n]
        better = ~self.full[query] | (score > self.limit[query]) | (found < self.last[query])
        if not better.any():
            return
        query = np.concatenate((self.query, query[better]))
        found, score = np.concatenate((self.found, found[better])), np.concatenate((self.score, score[better]))
        order = np.lexsort((found, ~score, query))
        counts = np.bincount(query, minlength=len(self.ids))
        rank = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = order[rank < self.k]
        self.query, self.found, self.score = query[order], found[order], score[order]
        counts = np.minimum(counts, self.k)
        self.full = counts == self.k
        ends = np.cumsum(counts)[self.full] - 1
        self.limit[self.full], self.last[self.full] = self.score[ends], self.found[ends]


def searched(queries: Iterable[dict], candidates: Iterable[dict], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query ids, candidate ids and scores: each query's best k of the blocks of candidates, itself left out.

    The queries of all blocks of ``queries`` are held, one block of candidates at a time.
    """
    asked = []
    for block in queries:
        ids, terms = np.frombuffer(block["ids"], np.int64), _terms(block)
        for first in range(0, len(ids), TOGETHER):
            part = slice(*np.searchsorted(terms[0], (first, first + TOGETHER)))
            asked.append(Asked(ids[first : first + TOGETHER], (terms[0][part] - first, terms[1][part], terms[2][part]), k))
    for block in candidates:
        held = Held(block)
        for some in asked:
            some.meet(held)
    for some in asked:
        yield some.ids[some.query], some.found, some.score


def _read(files: list[str]) -> Iterator[dict]:
    """The blocks of these files, few in memory at a time."""
    for uri in files:
        store, path = opened_store(uri)
        with store.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=4, columns=["ids", "lengths", "width", "weights"]):
                yield from batch.to_pylist()


def _dealt(sizes: list[tuple], parts: int) -> list[list]:
    """The names of ``(name, size)`` in ``parts`` lists of about the same size in all, the largest first."""
    filled, out = [(0, part) for part in range(parts)], [[] for _ in range(parts)]
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        total, part = heapq.heappop(filled)
        out[part].append(name)
        heapq.heappush(filled, (total + size, part))
    return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best candidates by inner product, all if there are fewer.

    Both tables are ``(vec_id, weights)`` of whole numbers.  Ties go to the smaller ``vec_id``; a candidate with the query's own
    id is left out.  Vectors of unequal length meet on the dimensions they share, an empty one scores zero with all.
    Rows that repeat a candidate's id count each; a query id that repeats is asked with each of its rows, and all that
    these find is ranked together.  No queries or no candidates give no rows.

    Every block of queries meets every block of candidates, which is the exhaustive search.  Blocks of queries are dealt into
    units of about ``UNIT``, files of candidates into groups; there is more than one group only where units are fewer than
    tasks are wanted.  A task takes a unit and reads the blocks of a group one after the other from the written files, so
    candidates are never copied and a task holds its queries, their best and one block.  Names and sizes of blocks and files are
    all that the driver sees.  k rows a query leave each task, to be merged by query.
    """
    spark = candidates.sparkSession
    cores = spark.sparkContext.defaultParallelism
    few = candidates.rdd.getNumPartitions() < cores
    asked = blocks(queries, QUERY_BLOCK, "query-blocks")
    held = blocks(candidates.repartition(cores) if few else candidates, block, "candidate-blocks")
    sizes = [tuple(r) for r in asked.select("block", "vectors").collect()]
    files = [tuple(r) for r in held.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.sum("vectors")).collect()]
    units = -(-sum(size for _, size in sizes) // UNIT)
    groups = max(1, min(len(files), -(-TASKS * cores // max(units, 1))))
    read = _dealt(files, groups)
    numbers = [(name, unit) for unit, names in enumerate(_dealt(sizes, units)) for name in names]
    named = spark.createDataFrame(numbers, "block bigint, unit int")
    tasks = F.sequence(F.col("unit") * groups, F.col("unit") * groups + groups - 1)
    copies = asked.join(F.broadcast(named), "block").withColumn("task", F.explode(tasks)).repartitionById(max(1, units * groups), F.col("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                rows.setdefault(row["task"], []).append(row)
        for task, own in rows.items():
            for found in searched(own, _read(read[task % groups]), k):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    best = copies.mapInArrow(run, SCORES)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def self_search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``top_k`` of the rows whose ``vec_id`` is divisible by ``every``, against all rows of ``(vec_id, embedding)``."""
    asked = vectors.filter(F.col("vec_id").cast("bigint") % every == 0)
    return top_k(quantised(asked), quantised(vectors), k)
