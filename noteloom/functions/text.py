"""Regex and string helpers with Unicode-aware meaning.

The functions of this package take and give Spark SQL expression text (``F.expr`` makes it a
column).  Nested lambdas are long to build call by call from Python but parse at once as text.
Lambda variables have names of their own in every function, so expressions nest safely.
"""

from __future__ import annotations

import sys
import unicodedata

from noteloom.functions.patterns import ascii_regex, unicode_regex

# Fixed value: the number inside a match.
NUMBER = r"\d+\.?\d*"

WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def lit(value) -> str:
    """A Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def lits(values) -> str:
    return ", ".join(map(lit, values))


def col(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def let(var: str, value: str, body: str) -> str:
    """Bind ``value`` to ``var`` in ``body``: evaluated once per row however often it is used, and
    the expression stays small when the optimizer moves it through projections."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def _by_charset(text: str, pattern: str, ignore_case: bool, call: str) -> str:
    fast = call.format(text, lit(ascii_regex(pattern, ignore_case)))
    exact = call.format(text, lit(unicode_regex(pattern, ignore_case)))
    return f"if(length({text}) = octet_length({text}), {fast}, {exact})"


def all_matches(text: str, pattern: str, ignore_case: bool = False) -> str:
    """All non-overlapping matches from left to right (NULL text has none)."""
    found = _by_charset(text, pattern, ignore_case, "regexp_extract_all({}, {}, 0)")
    return f"coalesce({found}, cast(array() AS array<string>))"


def first_match(text: str, pattern: str, ignore_case: bool = False) -> str:
    """The leftmost match, NULL if there is none."""
    return _by_charset(text, pattern, ignore_case, "regexp_substr({}, {})")


def gaps(text: str, pattern: str, ignore_case: bool = False) -> str:
    """The text around the matches of ``pattern``: one piece more than there are matches."""
    return _by_charset(text, pattern, ignore_case, "split({}, {}, -1)")


def strip(text: str) -> str:
    return f"btrim({text}, {lit(WHITESPACE)})"


def is_upper(text: str) -> str:
    return f"(upper({text}) = {text} AND lower({text}) <> {text})"


def is_lower(text: str) -> str:
    return f"(lower({text}) = {text} AND upper({text}) <> {text})"


def has_digit(text: str) -> str:
    """Decimal digits as well as raised, lowered and circled ones."""
    return f"({text} RLIKE {lit('[\\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]')})"


def _foreign_digits() -> tuple[str, str]:
    chars = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(chars), "".join(str(unicodedata.digit(c)) for c in chars)


FOREIGN_DIGITS, PLAIN_DIGITS = _foreign_digits()


def to_number(digits: str) -> str:
    """Decimal text to double; digits of any script count, other text gives NULL."""
    plain = f"translate({digits}, {lit(FOREIGN_DIGITS)}, {lit(PLAIN_DIGITS)})"
    return f"coalesce(try_cast({digits} AS double), try_cast({plain} AS double))"


def first_number(text: str) -> str:
    return let("num_", first_match(text, NUMBER), to_number("num_"))
