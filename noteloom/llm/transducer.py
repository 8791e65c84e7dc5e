"""Byte-level BPE with a minimal acyclic transducer of frequent words, and exact merging of all others.

The frequent words of the corpus are compiled, with their ids, into the smallest acyclic automaton that
accepts them: words share beginnings and endings.  Each transition carries a number, and the numbers on a word's
path add up to the word's place in the sorted list, where its ids are kept.  The automaton is a few
flat arrays that a worker maps into memory; all distinct words of a batch walk through it together, byte by
byte.  Words that it doesn't have are merged by rank, together as well.
"""

from __future__ import annotations

import heapq
import json
import mmap
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.scratch import written
from noteloom.llm.words import CUT_OFF, KNOWN, PART_BYTES, SPACES, Remembered, WordEncoder, byte_letters, sliced, take_ranges

LEXICON = 1 << 16  # frequent words in the automaton; the rest is merged
LEVELS = 16  # steps of frequency in each doubling
LONG = 64  # bytes; longer words are merged one by one
COUNTED = 200_000  # words that a task counts before it hands them on, and chunks before it cuts them into words
TOGETHER = 1 << 17  # ids decoded at once
NEVER = np.int64(1) << 40

# Fixed value: how texts are cut into words
WORDS = regex.compile(rf"{CUT_OFF}| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


class Merges:
    """The merge table of a vocabulary file: exact BPE over bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary, letters = held["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.byte_ids = np.array([vocabulary[chr(letters[b])] for b in range(256)], np.int64)
        self.width = max([*vocabulary.values(), *self.special.values()]) + 1
        self.rank: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(held["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault(vocabulary[left] * self.width + vocabulary[right], (rank, vocabulary[left + right]))
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        values = np.array(list(self.rank.values()), np.int64).reshape(-1, 2)
        self.keys, self.ranks, self.made = keys[order], values[order, 0], values[order, 1]
        self.byte_pairs = self._look_up((self.byte_ids[:, None] * self.width + self.byte_ids).ravel())
        # bytes of every token, for decoding
        byte_of = {chr(c): b for b, c in letters.items()}
        spelt = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in vocabulary.items()}
        spelt |= {i: t.encode() for t, i in self.special.items()}
        parts = [spelt.get(i, b"") for i in range(self.width)]
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.spelt = np.frombuffer(b"".join(parts), np.uint8)

    def _look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair, NEVER for pairs that don't merge."""
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NEVER), self.made[at]

    def long_word(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first, over a linked list."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before, gone = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], [False] * len(ids)
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (found := self.rank.get(ids[i] * self.width + ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i] = self.rank[left * self.width + right][1]
            gone[j], after[i] = True, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x, dropped in zip(ids, gone, strict=True) if not dropped]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and their number for each word; no word is empty.

        In each round every word merges its pair of lowest rank wherever it stands.  A merge makes no pair
        of lower rank than its own, so this is what merging one pair at a time, leftmost first, comes to.
        Only pairs that a merge made are looked up again.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(sizes <= LONG)
        letters = np.frombuffer(b"".join(words[i] for i in short), np.uint8)
        ids, of = self.byte_ids[letters], np.repeat(short, sizes[short])
        pairs = letters * np.int64(256) + np.append(letters[1:], np.uint8(0))  # the last one is none
        rank, made = (held[pairs] for held in self.byte_pairs)
        rank[np.append(of[:-1] != of[1:], True)[: len(rank)]] = NEVER
        done_ids, done_of = [], []
        while len(ids):
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(of))))
            over = least == NEVER
            done_ids.append(ids[over])
            done_of.append(of[over])
            merge = (rank == least) & ~over
            # of pairs that overlap, as in a run of one symbol, every second one merges
            places = np.flatnonzero(merge)
            fresh = np.append(True, np.diff(places) != 1)
            run_start = places[fresh][np.cumsum(fresh) - 1] if len(places) else places
            merge[places[(places - run_start) % 2 == 1]] = False
            ids[merge] = made[merge]
            keep = ~over
            keep[1:] &= ~merge[:-1]
            changed = merge.copy()
            changed[:-1] |= merge[1:]
            ids, of, rank, made, changed = (held[keep] for held in (ids, of, rank, made, changed))
            rank[-1:] = NEVER
            at = np.flatnonzero(changed[:-1])
            rank[at], made[at] = self._look_up(ids[at] * self.width + ids[at + 1])
            rank[at[of[at] != of[at + 1]]] = NEVER
        for i in np.flatnonzero(sizes > LONG).tolist():
            one = self.long_word(words[i])
            done_ids.append(np.array(one, np.int64))
            done_of.append(np.full(len(one), i))
        if not done_ids:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        ids, of = np.concatenate(done_ids), np.concatenate(done_of)
        return ids[np.argsort(of, kind="stable")].astype(np.uint32), np.bincount(of, minlength=len(words))

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell; some ids at a time, as each byte takes a few numbers of eight bytes on the way."""
        steps = (ids[at : at + TOGETHER] for at in range(0, len(ids), TOGETHER))
        return b"".join([take_ranges(self.spelt, self.starts[x], self.sizes[x]).tobytes() for x in steps])


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Transitions and accepting states of the smallest automaton of sorted distinct words; state 0 is the start.

    A word's own part is a fresh chain; when the next word leaves it, its states are replaced from the end by equal ones
    that were registered before.
    """
    edges: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    free: list[int] = []
    path: list[tuple[int, int]] = []  # (state, byte) along the last word

    def settle(depth: int) -> None:
        while len(path) > depth:
            state, byte = path.pop()
            child = edges[state][byte]
            known = register.setdefault((final[child], tuple(edges[child].items())), child)
            if known != child:
                edges[state][byte] = known
                free.append(child)

    last = b""
    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        settle(shared)
        state = edges[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[shared:]:
            if free:
                new = free.pop()
                edges[new], final[new] = {}, False
            else:
                new = len(edges)
                edges.append({})
                final.append(False)
            edges[state][byte] = new
            path.append((state, byte))
            state = new
        final[state] = True
        last = word
    settle(0)
    return edges, final


def compiled(words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """The automaton of sorted distinct words with the ids of each, as one block of flat arrays.

    Transitions lie in one table, at the state's base plus the byte; bases are chosen so that rows interlock.
    """
    edges, final = minimal_automaton(words)
    below: dict[int, int] = {}
    reached, stack = [], [0]
    while stack:  # children before parents
        state = stack.pop()
        if state >= 0:
            if state not in below:
                below[state] = -1
                stack.append(~state)
                stack += [c for c in edges[state].values() if c not in below]
        else:
            reached.append(~state)
            below[~state] = int(final[~state]) + sum(below[c] for c in edges[~state].values())
    slots = 256 + sum(len(edges[s]) for s in reached)
    free = np.ones(2 * slots + 512, bool)
    base = np.zeros(len(edges), np.int32)
    lowest, tried = 0, {}  # rows of one size look on from where the last found room
    for state in sorted(reached, key=lambda s: -len(edges[s])):
        if not edges[state]:
            continue
        row = np.fromiter(edges[state], np.int64, len(edges[state]))
        while not free[lowest]:
            lowest += 1
        begin = tried.get(len(row), 0) if len(row) > 1 else max(0, lowest - int(row.min()))
        while True:
            tries = np.arange(begin, begin + 256)
            if tries[-1] + 256 >= len(free):
                free = np.append(free, np.ones(len(free), bool))
            fits = free[tries[:, None] + row].all(axis=1)
            if fits.any():
                break
            begin += 256
        base[state] = tried[len(row)] = begin + int(fits.argmax())
        free[base[state] + row] = False
    top = int(base.max()) + 256
    owner, target, output = np.full(top, -1, np.int32), np.zeros(top, np.int32), np.zeros(top, np.int32)
    for state in reached:
        passed = int(final[state])
        for byte in sorted(edges[state]):
            child, at = edges[state][byte], base[state] + byte
            owner[at], target[at], output[at] = state, child, passed
            passed += below[child]
    ends = np.cumsum(sizes).astype(np.int32)
    parts = [base, np.array(final, np.int32), owner, target, output, np.append(np.int32(0), ends).astype(np.int32), ids.astype(np.uint32)]
    head = np.array([len(p) for p in parts], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """A compiled automaton in mapped memory."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:  # has no name; the mapping keeps it
            file.write(block)
            file.flush()
            self.held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        lengths, at, parts = np.frombuffer(self.held, np.int64, 7), 56, []
        for n in lengths.tolist():
            parts.append(np.frombuffer(self.held, np.uint32 if len(parts) == 6 else np.int32, n, at))
            at += 4 * n
        self.base, self.final, self.owner, self.target, self.output, self.bounds, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the list, -1 for words that are not in it."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        state, total, found = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
        going, step = np.arange(len(words)), 0
        while len(going):
            over = sizes[going] == step
            ended = going[over]
            accepted = ended[self.final[state[ended]] == 1]
            found[accepted] = total[accepted]
            going = going[~over]
            at = self.base[state[going]].astype(np.int64) + data[starts[going] + step]
            known = (at < len(self.owner)) & (self.owner[np.minimum(at, len(self.owner) - 1)] == state[going])
            going, at = going[known], at[known]
            total[going] += self.output[at]
            state[going] = self.target[at]
            step += 1
        return found


class LexiconEncoder(WordEncoder):
    """Encodes like its parent, words by automaton and merge table in place of the library.

    Merging takes some hundred bytes for each byte of an unknown word, so texts are taken in smaller parts.
    """

    part_bytes = 2 << 20

    def __init__(self, path: str, block: bytes):
        self.merges, self.lexicon = merge_table(path), Transducer(block)
        self.byte_level = True
        self.known = Remembered()
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True))) or "(?!)")

    def _distinct(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as bytes."""
        numbers = self.lexicon.numbers(words)
        unknown = [w for w, n in zip(words, numbers.tolist(), strict=True) if n < 0]
        bounds, held = self.lexicon.bounds, self.lexicon.ids
        merged = (ids for some in sliced(unknown) for ids in self._merged(some))
        return [held[bounds[n] : bounds[n + 1]].tobytes() if n >= 0 else next(merged) for n in numbers.tolist()]

    def _merged(self, words: list[bytes]) -> Iterator[bytes]:
        ids, sizes = self.merges.words(words)
        ends = (4 * np.cumsum(sizes)).tolist()
        data = ids.tobytes()
        return (data[s:e] for s, e in pairwise([0, *ends]))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        found = self.known.find(chunks)
        missing = [i for i, x in enumerate(found) if x is None]
        cut = {i: words_of(chunks[i], self.split, self.merges.special) for i in missing}
        whole = [chunks[i] for i, own in cut.items() if own == [chunks[i]]]  # were looked for as they are
        words = list({w: None for i, own in cut.items() if own != [chunks[i]] for w in own if isinstance(w, str)})
        wanted = dict(zip(words, self.known.find(words), strict=True))
        new = list(dict.fromkeys([*whole, *(w for w, ids in wanted.items() if not ids)]))
        made = self._distinct([w.encode("utf-8", "surrogatepass") for w in new])
        wanted.update(zip(new, made, strict=True))
        for i, own in cut.items():
            found[i] = b"".join([wanted[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in own])
        self.known.add([chunks[i] for i in missing], [found[i] for i in missing])
        return found


def words_of(chunk: str, split: regex.Pattern, special: dict[str, int]) -> list[str | int]:
    """The words of a chunk; special tokens as their ids."""
    if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()) and (chunk.isascii() or KNOWN.fullmatch(chunk)):
        return [chunk]
    if "<" not in chunk or not split.search(chunk):
        return WordEncoder.cut(chunk) if KNOWN.fullmatch(chunk) else WORDS.findall(chunk)
    out, at = [], 0
    for m in split.finditer(chunk):
        out += [*WORDS.findall(chunk[at : m.start()]), special[m[0]]]
        at = m.end()
    return out + WORDS.findall(chunk[at:])


@lru_cache(maxsize=2)
def merge_table(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def lexicon_encoder(path: str, block: bytes) -> LexiconEncoder:
    """One for each worker process."""
    return LexiconEncoder(path, block)


class _Counter(LexiconEncoder):
    """Counts words in place of encoding them: chunks first, so that a chunk met again is not cut again."""

    part_bytes = PART_BYTES

    def __init__(self, path: str):
        self.byte_level, self.chunks, self.seen = True, {}, {}
        self.special = merge_table(path).special
        self.split = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")

    def _gathered(self, values: pa.Array, first: np.ndarray | None, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts, codes = self.numbered(values, first)
        held = self.chunks.get
        self.chunks.update([(c, held(c, 0) + n) for c, n in zip(texts, np.bincount(codes, minlength=len(texts)).tolist(), strict=True)])
        if len(self.chunks) > COUNTED:
            self.cut_up()
        return np.zeros(0, np.uint32), np.zeros(len(counts), np.int64)

    def cut_up(self) -> None:
        """Counts the words of the chunks held so far."""
        chunks, self.chunks, held = self.chunks, {}, self.seen.get
        for chunk, n in chunks.items():
            for word in words_of(chunk, self.split, self.special):
                if isinstance(word, str):
                    self.seen[word] = held(word, 0) + n


def word_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(word, n)``: how often each word stands in all texts.  Tasks add up before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(vocabulary)

        def flush() -> pa.RecordBatch:
            seen, counter.seen = counter.seen, {}
            columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for _ in counter.encode(batch.column(0)):
                if len(counter.seen) > COUNTED:
                    yield flush()
        counter.cut_up()
        yield flush()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, vocabulary: str, size: int = LEXICON) -> bytes:
    """The compiled automaton of the most frequent words, at most ``size``.

    Counts are put on levels, ``LEVELS`` to each doubling, and the words of the highest levels are taken; of the level
    that does not fit whole, the first by word.  Only the sizes of the levels, some hundreds, and these words come to the
    driver.
    """
    counts = written(word_counts(docs, vocabulary).withColumn("level", F.floor(F.log2("n") * LEVELS).cast("int")), "word-counts")
    left, whole, frequent = size, [], []
    for row in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        if row["words"] > left:
            frequent = counts.filter(F.col("level") == row["level"]).select("word").orderBy("word").limit(left).collect()
            break
        left -= row["words"]
        whole.append(row["level"])
    if whole:
        frequent += counts.filter(F.col("level") >= min(whole)).select("word").collect()
    words = sorted(r["word"].encode("utf-8", "surrogatepass") for r in frequent)
    return compiled(words, *merge_table(vocabulary).words(words))


def encoded(docs: DataFrame, vocabulary: str, size: int = LEXICON) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every row of ``(doc_id, text)``: ids as little-endian unsigned 32-bit numbers, and the
    UTF-8 bytes of the text that the ids spell.

    The ids are those of the vocabulary's own library, special tokens in the text included.  Null and empty texts have
    no ids and decode to nothing.  Repeated rows and null ids are rows as any other; long texts, and
    words, are encoded whole by one task.  Other columns are ignored, and an empty table gives no rows.
    """
    block = docs.sparkSession.sparkContext.broadcast(lexicon(docs, vocabulary, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = lexicon_encoder(vocabulary, block.value)
        for batch in batches:
            for rows, flat, sizes in encoder.encode(batch.column(1)):
                flat = flat.astype("<u4")
                spelt = encoder.merges.decoded(flat)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                letters = np.concatenate(([0], np.cumsum(encoder.merges.sizes[flat])))[bounds].tolist()
                ids = [flat[s:e].tobytes() for s, e in pairwise(bounds.tolist())]
                texts = [spelt[s:e].decode("utf-8", "replace").encode() for s, e in pairwise(letters)]
                columns = [batch.column(0).slice(rows.start, len(ids)), pa.array(ids, pa.binary()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids binary, decoded binary")
