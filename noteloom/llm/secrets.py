"""Secrets in texts: three fixed patterns, and strings whose letters are too even to be words.

A candidate is a run of the letters of a character class.  A window slides over it; the counts of its letters change by
one that enters and one that leaves, and with them the sum of ``c log2 c`` from which the Shannon entropy of
the window follows.  Windows at or above the class's entropy that hold every kind of letter the class asks for are
joined to spans.  Spans that touch what the allow list names (addresses, identifiers, stated digests, alphabets,
placeholders) are dropped.  The patterns' own spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.words import parts

PART_BYTES = 8 << 20  # text in hand at once
SCALE = 1 << 32  # of the sums behind an entropy, which are whole numbers so that no error adds up

# The three patterns, the shortest value or match of each, and the words that an assignment begins with
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class CharacterClass(NamedTuple):
    kind: str
    letters: str
    width: int  # letters of a window
    bits: float  # entropy from which a window counts
    needs: tuple[str, ...]  # kinds of letters that a window has one of each at least


# Random windows of 24 letters have about 3.4, 3.9 and 4.2 bits, run-together words of prose 3.0 to 3.6 and no digits.
CLASSES = (
    CharacterClass("hex_entropy", DIGITS + "abcdef" + "ABCDEF", 24, 2.9, (DIGITS, LOWER + UPPER)),
    CharacterClass("base36_entropy", DIGITS + LOWER, 24, 3.6, (DIGITS, LOWER)),
    CharacterClass("base64_entropy", DIGITS + LOWER + UPPER + "+/_=-", 24, 3.9, (DIGITS, LOWER, UPPER)),
)
BASE_KINDS = ("assign", "access", "hex")

# What looks random and is no secret
ALLOWED = (
    r"(?:https?|ftp)://[^\s\"'<>]+",
    r"\b[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\b",
    r"(?i:\b(?:sha-?(?:1|224|256|384|512)|md5)\b[-:=\s]{1,2}[0-9a-z+/=]+)",
    r"data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+",
    r"(?i:abcdefghijklm|nopqrstuvwxyz|0123456789|qwertyuiop)",
    r"(?i:example|sample|dummy|placeholder|changeme)",
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The matches of the three patterns, leftmost and without overlap within each."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def even_windows(letters: str, width: int, bits: float, needs: tuple[str, ...] = ()) -> list[tuple[int, int]]:
    """Joined windows of ``letters`` of at least ``bits`` of entropy.

    The counts are carried from window to window, so the time is in proportion to the letters, whatever the width.
    """
    weight = [0] + [round(c * log2(c) * SCALE) for c in range(1, width + 1)]
    most = round(width * (log2(width) - bits) * SCALE)  # entropy = log2(width) - sum / width
    kind = {x: i for i, own in enumerate(needs) for x in own}
    counts: dict[str, int] = {}
    held, total, found = [0] * (len(needs) + 1), 0, []
    for i, letter in enumerate(letters):
        if i >= width:
            gone = letters[i - width]
            c = counts[gone]
            counts[gone] = c - 1
            total += weight[c - 1] - weight[c]
            held[kind.get(gone, -1)] -= 1
        c = counts.get(letter, 0)
        counts[letter] = c + 1
        total += weight[c + 1] - weight[c]
        held[kind.get(letter, -1)] += 1
        if i >= width - 1 and total <= most and all(held[: len(needs)]):
            start = i - width + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


class Scanner:
    """Finds the spans of one text after the other."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED):
        self.classes = [(c, self._candidates(c)) for c in classes]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed) or "(?!)")
        self.rank = {k: i for i, k in enumerate([*BASE_KINDS, *(c.kind for c in classes)])}
        # no candidate of any class is in a text without a run of this length
        letters = "".join(sorted({x for c in classes for x in c.letters}))
        width = min((c.width for c in classes), default=1)
        self.any = re.compile(f"(?<![{re.escape(letters)}])[{re.escape(letters)}]{{{width},}}") if letters else re.compile("(?!)")

    @staticmethod
    def _candidates(c: CharacterClass) -> re.Pattern:
        letters = re.escape("".join(dict.fromkeys(c.letters)))
        return re.compile(f"(?<![{letters}])[{letters}]{{{c.width},}}")

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans of high entropy that no pattern's span and no other of them covers, without those that the allow list touches."""
        found = []
        for region in self.any.finditer(text):
            for c, candidates in self.classes:
                for m in candidates.finditer(text, region.start(), region.end()):
                    found += [(c.kind, m.start() + s, m.start() + e) for s, e in even_windows(m[0], c.width, c.bits, c.needs)]
        if not found:
            return found
        allowed = [m.span() for m in self.allowed.finditer(text)]
        found = self._apart(found, allowed)
        # longer ones first, so that those inside them follow
        kept, stop = [], -1
        covers = sorted([(s, -e, -1, k) for k, s, e in base] + [(s, -e, self.rank[k], k) for k, s, e in found])
        for s, neg, rank, kind in covers:
            if -neg > stop:
                stop = -neg
                if rank >= 0:
                    kept.append((kind, s, -neg))
        return kept

    @staticmethod
    def _apart(spans: list[Span], others: list[tuple[int, int]]) -> list[Span]:
        """Those of ``spans`` that touch none of ``others``, which are in order and do not overlap."""
        out, at = [], 0
        for kind, s, e in sorted(spans, key=lambda x: x[1]):
            while at < len(others) and others[at][1] <= s:
                at += 1
            if at == len(others) or others[at][0] >= e:
                out.append((kind, s, e))
        return out

    def spans(self, text: str) -> list[Span]:
        """All spans by start, then kind as listed."""
        base = base_spans(text)
        return sorted(base + self.added(text, base), key=lambda x: (x[1], self.rank[x[0]]))


def secret_spans(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``(doc_id, spans)`` of every row of ``(doc_id, text)``; a span has its kind, start and end in code points, end exclusive.

    Kinds are ``assign``, ``access`` and ``hex``, then those of ``classes``; spans of different kinds may overlap.  Null and
    empty texts have no spans; repeated rows and null ids are rows as any other; other columns are ignored, and an empty
    table gives no rows.  Long texts are scanned whole, in time in proportion to them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        fields = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            for rows in parts(texts, PART_BYTES):
                found = [
                    [{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(text)]
                    for text in texts.slice(rows.start, rows.stop - rows.start).to_pylist()
                ]
                columns = [batch.column(0).slice(rows.start, len(found)), pa.array(found, pa.list_(fields))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def written_spans(spans: str) -> str:
    """Spans of a row as ``kind:start:end`` joined by commas, as SQL text."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, cast(s.start AS string), cast(s.`end` AS string))), ',')"
