"""Token ids of whole texts by the tokenizers library, with each distinct word encoded once.

A text is cut into chunks at white space where no token can reach over: the ids of a text are those of
its chunks, one after the other.  Distinct chunks of a batch are encoded, ids are gathered by number.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_BYTES = 128 << 20  # of chunks, words and their ids that a worker remembers from batch to batch, about
ENTRY_BYTES = 180  # that a remembered chunk takes beside its letters and ids
LONGEST = 64  # characters of a chunk that is remembered
PART_BYTES = 4 << 20  # text encoded at once
SLICE_BYTES = 256 << 10  # of it that the library or a merge table takes at once, as they need some hundred times as much

# Letters and numbers below U+0250, white space of the tokenizers, and words cut off at apostrophes
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
BLANKS = "\t-\r "
SPACES = "\t-\r \u0085   -     　"
CUT_OFF = "'(?:s|t|re|ve|m|ll|d)"

# Chunks of these characters only are cut into words here, others by the library
KNOWN = re.compile("[\t-\r -~¡-įı-ɏ]*")
CHUNK = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
AFTER_SPACE = "[\t-\r \\x{85}\\p{Z}] "
WORDS = {
    True: re.compile(f"{CUT_OFF}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"),
    False: re.compile(f"{CUT_OFF}|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+"),
}


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from U+0100 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


def take_ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` that begin at ``starts``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def sliced(texts: list, size: int = SLICE_BYTES) -> Iterator[list]:
    """``texts`` in their order, in lists of about ``size`` characters or bytes; a longer text is a list of its own."""
    at, held = 0, 0
    for end, text in enumerate(texts):
        if held and held + len(text) > size:
            yield texts[at:end]
            at, held = end, 0
        held += len(text)
    if at < len(texts):
        yield texts[at:]


def parts(texts: pa.Array, size: int) -> Iterator[slice]:
    """The rows of ``texts`` in their order, about ``size`` bytes at a time; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
    return (slice(start, end) for start, end in pairwise(cuts) if end > start)


@contextmanager
def unswept() -> Iterator[None]:
    """Without Python's search for cycles: lists of words make none, and it would go through all of them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Remembered:
    """Ids of the texts met last, in two halves: when the newer one is full it becomes the older one, which is dropped.

    Bounded in bytes whatever the texts are; long ones, which hardly come again, are not kept.
    """

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held = limit, 0
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def find(self, texts: list[str]) -> list[bytes | None]:
        found = list(map(self.recent.get, texts))
        if self.older:
            older = self.older.get
            found = [x or older(t) for t, x in zip(texts, found, strict=True)]
        return found

    def add(self, texts: list[str], ids: list[bytes]) -> None:
        kept = {t: x for t, x in zip(texts, ids, strict=True) if len(t) <= LONGEST}
        if not kept:
            return
        before = len(self.recent)
        self.recent.update(kept)
        letters = 2 * sum(map(len, kept)) + sum(map(len, kept.values()))
        self.held += (len(self.recent) - before) * (ENTRY_BYTES + letters // len(kept))
        if self.held > self.limit // 2:
            self.older, self.recent, self.held = self.recent, {}, 0


def put_back(odd: np.ndarray, others: tuple[np.ndarray, np.ndarray], odd_ones: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and numbers of ids of rows that were encoded apart, in the order of the rows."""
    total = np.concatenate((others[1], odd_ones[1]))
    starts = np.cumsum(total) - total
    order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
    where = np.empty_like(order)
    where[order] = np.arange(len(order))
    return take_ranges(np.concatenate((others[0], odd_ones[0])), starts[where], total[where]), total[where]


class WordEncoder:
    """Encodes arrays of texts as ``encode(text, add_special_tokens=False).ids`` would.

    ``byte_level`` says which of the two kinds of vocabulary the file holds: spaces kept before words, or lower case
    with spaces dropped.  With ``plain`` the strings of special tokens in a text are text like any other.
    """

    part_bytes = PART_BYTES

    def __init__(self, path: str, byte_level: bool, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        self.byte_level = byte_level
        self.words, self.letters = WORDS[byte_level], byte_letters()
        self.known = Remembered()

    def _word(self, word: str) -> bytes:
        plain = word[1:].isalpha() and word.isascii()
        written = f"\u0120{word[1:]}" if plain and word[0] == " " else word if plain else word.encode().decode("latin1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as bytes."""
        found = self.known.find(chunks)
        missing = [i for i, x in enumerate(found) if x is None]
        hard, cut = [], {}
        for i in missing:
            chunk = chunks[i]
            if self.byte_level and chunk[1:].isalpha() and chunk.isascii() and (chunk[0] == " " or chunk[0].isalpha()):
                found[i] = self._word(chunk)  # one word
            elif "<|" in chunk or not KNOWN.fullmatch(chunk):
                hard.append(i)
            else:
                cut[i] = self.words.findall(chunk if self.byte_level else chunk.lower())
        words = list({w: None for own in cut.values() for w in own})
        ids = dict(zip(words, self.known.find(words), strict=True))
        new = [w for w, x in ids.items() if not x]
        made = [self._word(w) for w in new]
        self.known.add(new, made)
        ids.update(zip(new, made, strict=True))
        for i, own in cut.items():
            found[i] = ids[own[0]] if len(own) == 1 else b"".join([ids[w] for w in own])
        at = iter(hard)
        for texts in sliced([chunks[i] for i in hard]):
            for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                found[next(at)] = array("I", made.ids).tobytes()
        self.known.add([chunks[i] for i in missing], [found[i] for i in missing])
        return found

    @staticmethod
    def cut(chunk: str) -> list[str]:
        """The words of a byte-level chunk of known characters."""
        return WORDS[True].findall(chunk)

    @staticmethod
    def numbered(values: pa.Array, first: np.ndarray | None) -> tuple[list[str], np.ndarray]:
        """Distinct chunks, and the number of each chunk among them; chunks not ``first`` get a space before them."""
        coded = values.dictionary_encode()
        codes, texts = coded.indices.to_numpy(), coded.dictionary
        if first is not None:
            codes = codes * 2 + ~first
            used = np.zeros(2 * len(texts), bool)
            used[codes] = True
            places = np.flatnonzero(used)
            before = pa.array(["", " "], texts.type).take(pa.array(places & 1))
            texts = pc.binary_join_element_wise(before, texts.take(pa.array(places >> 1)), pa.scalar("", texts.type))
            renumbered = np.zeros(len(used), np.int64)
            renumbered[places] = np.arange(len(places))
            codes = renumbered[codes]
        return texts.to_numpy(zero_copy_only=False).tolist(), codes

    def _gathered(self, values: pa.Array, first: np.ndarray | None, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each text, from its chunks; chunks not ``first`` have a space before them."""
        texts, codes = self.numbered(values, first)
        ids = self._chunks(texts)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        each = sizes[codes]
        bounds = np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], np.cumsum(counts)))]
        return take_ranges(flat, (np.cumsum(sizes) - sizes)[codes], each), np.diff(bounds)

    def part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.byte_level:
            pieces = pc.ascii_split_whitespace(texts)
            return self._gathered(pieces.flatten(), None, pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64))
        odd = pc.match_substring_regex(texts, AFTER_SPACE).to_numpy(zero_copy_only=False)
        pieces = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(int(counts.sum()), bool)
        first[np.cumsum(counts) - counts] = True
        flat, sizes = self._gathered(pieces.flatten(), first, counts)
        if not odd.any():
            return flat, sizes
        return put_back(odd, (flat, sizes), self.cut_by(CHUNK, texts.filter(pa.array(odd))))

    def cut_by(self, chunk: re.Pattern, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each text, cut into chunks by a pattern."""
        cut = [chunk.findall(t) for t in texts.to_pylist()]
        values = pa.array([c for own in cut for c in own], pa.large_string())
        return self._gathered(values, None, np.array([len(c) for c in cut], np.int64))

    def encode(self, texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Some texts after the other: which, their ids in one array, and the number of ids of each.  Null texts are empty."""
        for rows in parts(texts, self.part_bytes):
            with unswept():
                ids, lengths = self.part(texts.slice(rows.start, rows.stop - rows.start).cast(pa.large_string()).fill_null(""))
            yield rows, ids, lengths


@lru_cache(maxsize=2)
def word_encoder(path: str, byte_level: bool, plain: bool = False) -> WordEncoder:
    """One for each worker process, so that what it remembers serves all its tasks."""
    return WordEncoder(path, byte_level, plain)
