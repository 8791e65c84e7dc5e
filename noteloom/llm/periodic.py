"""Runs of repeated words, found online by sparse diagonals.

A word equal to the one ``lag`` places before lies on the diagonal of that lag; a run of period q is a stretch of such
words on the diagonal q that goes on for long enough.  Words are read once.  Every open diagonal whose earlier word is
the same grows by one, every other one ends, and is emitted if it is long enough.  An earlier occurrence of the word
opens a diagonal only where its lag divides the word's number: a run repeats more than twice, so each meets
such a place, and there it looks back to where it began.  So a word looks at its earlier occurrences, or at the divisors of
its number where these are fewer, and a word that fills a text costs no more than others.

A lag is not opened inside a stretch of one of its divisors: all of it has that shorter period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.words import parts

SHORTEST = 6  # words of the shortest run
REPEATS = 4  # periods that a run holds at least
MANY = 24  # earlier occurrences beyond which divisors are tried in their place
PART_BYTES = 8 << 20  # text in hand at once
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


@lru_cache(maxsize=4)
def least_factors(size: int) -> list[int]:
    """The smallest prime factor of every number below ``size``."""
    least = np.arange(size)
    for p in range(2, int(size**0.5) + 1):
        if least[p] == p:
            own = least[p * p :: p]
            own[own == np.arange(p * p, size, p)] = p
    return least.tolist()


def divisors(number: int, factors: list[int]) -> list[int]:
    """All divisors of a number, smallest first."""
    found = [1]
    while number > 1:
        p, power, more = factors[number], 1, []
        while number % p == 0:
            number //= p
            power *= p
            more += [d * power for d in found]
        found += more
    return sorted(found)


def runs_of(words: list, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[Run]:
    """``(start, length, period)`` of every run, by start, then period.

    A run is a stretch of words with smallest period ``period``, which no neighbouring word extends, of at least ``shortest``
    words and ``repeats`` periods.  ``repeats`` is 3 at least, so that a run meets a place where it can be opened and
    two runs on one stretch can't have different smallest periods.
    """
    if repeats < 3:
        raise ValueError("runs of fewer than three periods are not found")
    n, longest = len(words), len(words) // repeats
    if n < shortest or not longest:
        return []
    places: dict = {}
    open_since: dict[int, int] = {}  # lag: number of the first word that was equal to the one before by it
    found: list[Run] = []
    factors: list[int] | None = None

    def end(lag: int, at: int) -> None:
        since = open_since.pop(lag)
        length = at - since + lag
        if length >= shortest and length >= repeats * lag:
            found.append((since - lag, length, lag))

    for i, word in enumerate(words):
        if open_since:
            for lag in [lag for lag in open_since if words[i - lag] != word]:
                end(lag, i)
        earlier = places.get(word)
        if earlier is None:
            places[word] = [i]
            continue
        if len(earlier) > MANY and i - earlier[-MANY] <= longest:
            if factors is None:
                factors = least_factors(1 << n.bit_length())
            lags = [d for d in divisors(i, factors) if d <= longest and words[i - d] == word]
        else:
            lags = []
            for j in reversed(earlier):
                if i - j > longest:
                    break
                if not i % (i - j):
                    lags.append(i - j)
        earlier.append(i)
        for lag in lags:
            if lag in open_since or any(not lag % d and since - d <= i - lag for d, since in open_since.items()):
                continue
            since = i
            while since > lag and words[since - 1] == words[since - 1 - lag]:
                since -= 1
            open_since[lag] = since
    for lag in list(open_since):
        end(lag, n)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[Run]) -> list:
    """``words`` without those that any run holds after its first period."""
    kept, at = [], 0
    for start, stop in sorted((s + q, s + length) for s, length, q in runs):
        if start > at:
            kept += words[at:start]
        at = max(at, stop)
    return kept + words[at:] if runs else words


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """``(doc_id, runs, collapsed)`` of every row of ``(doc_id, text)``.

    Words are what stands between spaces and ASCII control blanks, ``runs`` numbers them from 0, and ``collapsed`` is the text
    with each run cut to its first period, words joined by one space.  ``rewrite`` may change a row's words first.
    Null and empty texts have no runs and collapse to nothing; repeated rows and null ids are rows as any other;
    other columns are ignored, and an empty table gives no rows.  Long texts are taken whole, in one task: time is in proportion
    to their words (times the few divisors of a word's number), memory to the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            for rows in parts(texts, PART_BYTES):
                ids = batch.column(0).slice(rows.start, rows.stop - rows.start)
                found, left = [], []
                for doc_id, text in zip(ids.to_pylist(), texts.slice(rows.start, len(ids)).to_pylist(), strict=True):
                    words = text.split()  # bytes: at the space and at 0x09 to 0x0D, as asked
                    if rewrite is not None:
                        words = rewrite(doc_id, words)
                    own = runs_of(words, shortest, repeats)
                    found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                    left.append(b" ".join(collapsed(words, own)))
                fields = pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])
                columns = [ids, pa.array(found, pa.list_(fields)), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id bigint, runs {RUNS}, collapsed string")


def longest_run(runs: str = "runs") -> str:
    """The longest run of a row as SQL text: the earliest, then shortest period of equal ones; NULL if there is none."""
    best = f"array_max(transform({runs}, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))"
    return f"transform(array({best}), r -> named_struct('start', -r.start, 'length', r.length, 'period', -r.period))[0]"
