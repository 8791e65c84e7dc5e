"""Annotation columns that hold literal lists as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions.text import let, lit, lits
from noteloom.sources.schemas import SPAN

_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
    "mode": "PERMISSIVE",
}
# a quoted string, a quote without an end, or the text between strings; possessive, as Java keeps a
# stack frame for every repetition that it might give back
_TOKEN = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|['"]|[^'"]++"""
_HEX = r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})"
_TRAILING_COMMA = r",(\s*[\]}])"


def literal_to_json(text: str) -> str:
    """Literal syntax to JSON syntax.  Only text outside quoted strings has its words translated;
    inside them hexadecimal escapes are."""
    inside = f"regexp_replace(lj_t, {lit(_HEX)}, {lit(r'$1\\u00$2')})"
    outside = "lj_t"
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        outside = f"regexp_replace({outside}, {lit(rf'\b{word}\b')}, '{json}')"
    outside = f"regexp_replace({outside}, {lit(_TRAILING_COMMA)}, '$1')"
    parts = f"regexp_extract_all({text}, {lit(f'(?s){_TOKEN}')}, 0)"
    return f"array_join(transform({parts}, lj_t -> if(substring(lj_t, 1, 1) IN ('\"', '\\''), {inside}, {outside})), '')"


def parse_literal(text: str, schema: str) -> Column:
    """The list in ``text``; a list cut off before its closing bracket is repaired, and what still
    cannot be read is empty."""
    options = "map(" + lits(x for kv in _OPTIONS.items() for x in kv) + ")"

    def read(json: str) -> str:
        # a list must be closed: the reader alone would also take the readable part of a broken one
        return f"if({json} RLIKE {lit(r'(?s)^\s*\[.*\]\s*$')}, from_json({json}, {lit(schema)}, {options}), NULL)"

    parsed = f"coalesce({read('pl_j')}, {read("concat(pl_j, ']')")}, cast(array() AS {schema}))"
    return F.expr(let("pl_j", f"coalesce({literal_to_json(text)}, '')", parsed))


def parse_spans(text: str) -> Column:
    """``array<struct<entity, label, start, end>>``"""
    return parse_literal(text, f"ARRAY<{SPAN}>")


def parse_labels(text: str) -> Column:
    """``array<string>``"""
    return parse_literal(text, "ARRAY<STRING>")


def parse_annotations(rows: DataFrame) -> DataFrame:
    """Parse the three annotation columns of source rows."""
    return rows.withColumns(
        {
            "icd_label": parse_labels("icd_label"),
            "annonymisation": parse_spans("annonymisation"),
            "disease": parse_spans("disease"),
        }
    )
