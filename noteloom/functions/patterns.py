"""Note patterns and their Java form.

The patterns are written in the common regex notation with Unicode-aware ``\\b``,
``\\d`` and ``\\s``.  Java's shorthands are ASCII-only (or differ between Java
versions), so :func:`unicode_regex` spells them out before Spark sees them.
"""

from __future__ import annotations

import re

# Names, order and text of the clinical patterns (matched ignoring case).
CLINICAL_PATTERNS = {
    "vital_sign": r"\b(?:HR|Hr|hr|RR|rr|CRT|Crt|crt|BP)\s*[=:]?\s*\d+\.?\d*",
    "temperature": r"\bT\s*[=:]?\s*\d+\.\d+",
    "weight": r"\b\d+\.?\d*\s*(?:kg|Kg|KG|lbs|g)\b",
    "age": r"\b\d+\s*(?:yo|y\.?o\.?|yr|yrs|years?|mo|months?|wk|wks|weeks?)\b",
    "sex_neuter": r"\b(?:FS|FN|MN|MC|MI|FI|FE|ME|MIFE)\b",
    "clinical_status": r"\b(?:BAR|NAD|QAR|ADR|TPR|DRB|BARH)\b",
    "dosage": r"\b\d+\.?\d*\s*(?:mg/kg|mg|ml|IU|mcg)(?:\s*(?:PO|IV|SC|IM|SID|BID|TID|QID|EOD|PRN|q\d+h))?\b",
}

# Names, order and text of the identifier patterns (case-sensitive).
# The order decides placeholder numbering and ties.
IDENTIFIER_PATTERNS = {
    "PHONE": r"\b(?:07\d{3}\s?\d{6}|0\d{3,4}\s?\d{3}\s?\d{3,4})\b",
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "POSTCODE": r"\b[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2}\b",
    "MICROCHIP": r"\b\d{15}\b",
    "DATE": r"\b\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4}\b"
    r"|\b\d{1,2}[\-](?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[\-]\d{2,4}\b",
    "ID": r"\b\d{5,7}[A-Z]?\b(?=\s*MRCVS)",
}

# Fixed value: whole words of two to five capitals, scanned by the raw accuracy score.
CAPITALS_PATTERN = r"\b[A-Z]{2,5}\b"

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
DIGIT = r"\p{Nd}"
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"


def _tuned(pattern: str, ignore_case: bool) -> str:
    """A clinical pattern that finds the same matches sooner.

    Nothing that follows a run of digits or spaces in these patterns can start with one, so runs
    never need to be given back; and the first character is looked at before the boundary.
    """
    out = pattern
    for run in (r"\d+", r"\d*", r"\s*"):
        out = out.replace(run, run + "+")
    heads = re.match(r"\\b\(\?:([A-Za-z|]+)\)", pattern) or re.match(r"\\b([A-Z])", pattern)
    if not heads:
        return out
    first = {word[0] for word in heads.group(1).split("|")}
    if ignore_case:
        first |= {c.lower() for c in first} | {c.upper() for c in first}
    return f"(?=[{''.join(sorted(first))}]){out}"


def ascii_regex(pattern: str, ignore_case: bool = False) -> str:
    """The pattern for text known to be ASCII, where Java's fast shorthands mean the same."""
    out = _tuned(pattern, ignore_case) if pattern in CLINICAL_PATTERNS.values() else pattern
    return ("(?i)" if ignore_case else "") + out.replace(r"\s", r"[\t-\r\x1c-\x1f ]").replace(WORD, r"\w")


def unicode_regex(pattern: str, ignore_case: bool = False) -> str:
    """The pattern for any text, with the Unicode meaning of each shorthand spelled out."""
    # before something that is surely a word character a boundary needs only the look behind
    out = re.sub(r"\\b(?=\\d|\[A-Z\]|\w|\(\?:[\w\\])", lambda _: f"(?<!{WORD})", pattern)
    out = out.replace(r"\b", BOUNDARY).replace(r"\d", DIGIT).replace(r"\s", SPACE)
    return ("(?iu)" if ignore_case else "") + out
