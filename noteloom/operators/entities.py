"""Entity spans: tagging by cue words and gazetteer, and the filters put on them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.functions import spans as S
from noteloom.functions.patterns import WORD
from noteloom.functions.text import all_matches, col, has_digit, is_lower, is_upper, let, lit, lits, strip
from noteloom.functions.vocabulary import GAZETTEER, STOPLIST

ENTITY_LABELS = ["PERSON", "ORG", "GPE", "LOC", "DATE"]
REDACTED_TYPES = ["PERSON", "ORG", "LOCATION"]
LABEL_TO_TYPE = {"PERSON": "PERSON", "ORG": "ORG", "GPE": "LOCATION", "LOC": "LOCATION"}

_NAME = r"[\p{Lu}][\p{L}'’-]++"
_MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
# the capital is looked for before the title in front of it, which is rarely there
PERSON_CUE = rf"(?=\p{{Lu}})(?<=\b(?:Mr|Mrs|Ms|Miss|Dr|Prof)\.? ){_NAME}(?: {_NAME})*+"
DATE_CUE = rf"\b\d{{1,2}}[ -]{_MONTH}(?:[ -]\d{{2,4}})?\b|\b{_MONTH} \d{{4}}\b"
# names by label, or a table (name, label)
Gazetteer = dict[str, list[str]] | DataFrame

# Places that the runs of one beginning are dealt to.
SALTS = 8
# First tokens of names that are looked for by a pattern, if there are no more of them and no more characters in them.
ROOTS = 256
ROOT_CHARACTERS = 10_000

PLACEHOLDER = r"\[[A-Z]+_\d+\]"


def name_pattern(names: list[str]) -> str:
    """Any of ``names`` as whole words, the longest first."""
    ordered = sorted(names, key=lambda n: (-len(n), n))
    heads = "".join(sorted({re.escape(n[0]) for n in names}))
    return rf"(?=[{heads}])(?<!{WORD})(?:{'|'.join(map(re.escape, ordered))})(?!{WORD})"


def _cues(gazetteer: dict[str, list[str]]) -> list[tuple[str, str]]:
    cues = [("PERSON", PERSON_CUE), ("DATE", DATE_CUE)]
    for label, names in gazetteer.items():
        if names:
            cues.append((label, name_pattern(names)))
    return cues


def tagged_spans(text: str, gazetteer: dict[str, list[str]] | None = None, given: str | None = None) -> str:
    """``array<struct<text, label, start, end>>`` of the entities in ``text``, without overlaps.

    A title followed by capitalised words is a PERSON, a day with a month a DATE, a gazetteer
    name what the gazetteer says.  ``given`` is an expression of more spans of the same kind, which follow
    the same rules; it takes the place of the gazetteer.  Spans that touch a placeholder are not entities.
    """
    cues = _cues({} if given is not None else GAZETTEER if gazetteer is None else gazetteer)
    each = [S.pattern_spans(text, p, i) for i, (_, p) in enumerate(cues)]
    labels = f"array({lits(label for label, _ in cues)})"
    if given is not None:
        # of equal spans the label that comes first by name stays
        more = f"cast({len(cues)} + array_position(tg_l, tg_g.label) - 1 AS int)"
        each.append(f"transform({given}, tg_g -> {S.span('tg_g.start', 'tg_g.`end`', more)})")
        labels = f"concat({labels}, tg_l)"
    free = f"""filter(concat({', '.join(each)}), tg_s ->
      NOT exists(tg_b, tg_p -> tg_s.start < tg_p.stop AND tg_p.start < tg_s.stop))"""
    kept = S.drop_overlapping(let("tg_b", S.pattern_spans(text, PLACEHOLDER, 0), free))
    tagged = f"""transform({kept}, tg_x -> named_struct('text', {S.slice_text(text, 'tg_x.start', 'tg_x.stop')},
      'label', get({labels}, tg_x.rank), 'start', tg_x.start, 'end', tg_x.stop))"""
    return tagged if given is None else let("tg_l", f"array_sort(array_distinct(transform({given}, tg_n -> tg_n.label)))", tagged)


def tag_entities(notes: DataFrame, gazetteer: Gazetteer | None = None, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Long span table ``(key, text, label, start, end)``.

    With lists of names, or the shipped ones, row-local and without a shuffle; with a table
    ``(name, label)`` of any size by :func:`with_gazetteer`, with the same result.
    """
    if isinstance(gazetteer, DataFrame):
        notes, tagged = with_gazetteer(notes.select(key, text), gazetteer, text, key), tagged_spans(col(text), given="_given")
    else:
        tagged = tagged_spans(col(text), gazetteer)
    long = notes.select(key, F.explode_outer(F.expr(tagged)).alias("s"))
    return long.filter("s IS NOT NULL").select(key, "s.text", "s.label", "s.start", "s.end")


def _by_first_token(names: DataFrame, token: str) -> DataFrame:
    """``(root, sizes, most, longest, word)`` of each first token: the numbers of tokens of its names, the largest, the most characters,
    and whether it is a word."""
    parts = names.select(F.expr(all_matches("name", token)).alias("t"), F.length("name").alias("chars"))
    each = parts.groupBy(F.expr("get(t, 0)").alias("root"), F.size("t").alias("n")).agg(F.max("chars").alias("chars"))
    by_root = each.groupBy("root").agg(F.collect_set("n").alias("sizes"), F.max("n").alias("most"), F.max("chars").alias("longest"))
    return by_root.withColumn("word", F.expr(f"root RLIKE {lit('^' + WORD)}"))


def _pieces(text: str, roots: dict[str, bool]) -> str:
    """``text`` cut before each of ``roots`` that is a token with no word character before it; the first piece may begin with another.

    ``roots`` says of each whether it is a word.
    """
    heads: dict[str, list[str]] = {}
    for root in sorted(roots):
        heads.setdefault(root[0], []).append(re.escape(root[1:]))

    def cut(word: str) -> str:
        # after a single character that is no word a name goes on in any way
        ends = {root[0]: f"(?!{word})" if is_word else "" for root, is_word in roots.items()}
        any_root = "|".join(f"{re.escape(head)}(?:{'|'.join(rest)}){ends[head]}" for head, rest in heads.items())
        return lit(rf"(?s).+?(?=(?<!{word})(?:{any_root})|\z)")

    found = f"if(length({text}) = octet_length({text}), regexp_extract_all({text}, {cut(chr(92) + 'w')}, 0), regexp_extract_all({text}, {cut(WORD)}, 0))"
    return f"coalesce({found}, cast(array() AS array<string>))"


def gazetteer_spans(notes: DataFrame, gazetteer: DataFrame, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """Every place where a name of a gazetteer table ``(name, label)`` stands, overlapping ones too.

    A text is a row of tokens: words, and single characters of any other kind.  A name is found where its tokens follow each
    other, unless a word character stands right before or after it.  Only where a first token of names stands as many tokens are
    put together as its names have: few first tokens are looked for by a pattern in each row, more by an equi-join.  What is put
    together meets the names by one equi-join on its hashes, which Spark broadcasts or shuffles by size; no text goes with
    it.  Runs and names that are equal by two 64-bit hashes are taken to be the same.
    """
    token = f"{WORD}+|(?s:.)"
    names = gazetteer.select("name", "label").filter("name IS NOT NULL AND label IS NOT NULL AND name <> ''")
    by_root = _by_first_token(names, token)
    roots = by_root.limit(ROOTS + 1).collect()
    few = len(roots) <= ROOTS and sum(len(r.root) for r in roots) <= ROOT_CHARACTERS
    # the numbers that the plan depends on
    most, longest = (max((r[x] for r in roots), default=0) for x in (2, 3)) if few else by_root.agg(F.max("most"), F.max("longest")).first()
    if not most:
        return notes.select(key, F.lit("").alias("text"), F.lit("").alias("label"), F.lit(0).alias("start"), F.lit(0).alias("end")).filter("false")

    # a name and the character after it lie in the first characters of as many pieces; no piece is empty
    tail = f"substring(array_join(slice(gz_c, gz_i + 1, {most + 1}), ''), 1, {longest + 1})"
    run = f"named_struct('start', get(gz_b, gz_i), 'tail', {tail})"
    places = "sequence(0, size(gz_t) - 1)"
    if not few:
        word = f"RLIKE {lit('^' + WORD)}"
        places = f"filter({places}, gz_j -> NOT (coalesce(get(gz_t, gz_j - 1) {word}, false) AND NOT get(gz_t, gz_j) {word}))"
    cut = f"transform(gz_t, gz_l -> substring(gz_l, 1, {longest + 1}))"
    runs = let("gz_b", S.running("transform(gz_t, gz_l -> length(gz_l))"), let("gz_c", cut, f"transform({places}, gz_i -> {run})"))
    every = let("gz_t", _pieces(col(text), {r.root: r.word for r in roots}) if few else all_matches(col(text), token), f"if(size(gz_t) = 0, NULL, {runs})")
    # the outer form keeps the optimizer from evaluating the array a second time in a filter
    rows = notes.select(key, F.explode_outer(F.expr(every)).alias("r")).filter("r IS NOT NULL")
    # very frequent first tokens and names are in several places
    salt = F.pmod(F.xxhash64(key, "r.start"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    rows = rows.select(key, "r.start", salt, F.expr(all_matches("r.tail", token)).alias("t"))
    if few:
        known = f"map_from_arrays(array({lits(r.root for r in roots)}), array({', '.join(f'array({lits(sorted(r.sizes))})' for r in roots)}))"
        rows = rows.withColumn("sizes", F.expr(f"try_element_at({known}, get(t, 0))"))
    else:
        rows = rows.withColumn("root", F.expr("get(t, 0)")).join(by_root.select("root", "sizes").withColumn("salt", salts), ["root", "salt"])
    hashes = "xxhash64({0}) AS h0", "xxhash64(1L, {0}) AS h1"
    ended = f"sz <= size(t) AND NOT coalesce(get(t, sz) RLIKE {lit('^' + WORD)}, false)"
    together = f"transform(filter(sizes, sz -> {ended}), ss -> array_join(slice(t, 1, ss), ''))"
    whole = rows.select(key, "start", "salt", F.explode_outer(F.expr(together)).alias("s")).filter("s IS NOT NULL")
    whole = whole.select(key, "start", "salt", *[F.expr(h.format("s")) for h in hashes])
    known = names.distinct().select("name", "label", F.length("name").alias("n"), *[F.expr(h.format("name")) for h in hashes]).withColumn("salt", salts)
    same = whole.join(known, ["h0", "h1", "salt"])
    return same.select(key, F.col("name").alias("text"), "label", "start", F.expr("start + n").alias("end"))


def with_gazetteer(notes: DataFrame, gazetteer: DataFrame, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """``notes`` with ``_given``: the names of a gazetteer table in their text, for :func:`tagged_spans`.

    As with lists, a name does not start inside another of its label.  ``key`` is unique in ``notes``.
    """
    found = gazetteer_spans(notes, gazetteer, text, key)
    # places and labels: nothing else of a note's text is collected
    all_found = found.groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct("label", "start", "end")).alias("all"))
    own = f"transform(filter(`all`, wg_s -> wg_s.label = wg_l), wg_s -> {S.span('wg_s.start', 'wg_s.`end`', '0')})"
    named = f"transform({S.drop_overlapping(own)}, wg_x -> named_struct('label', wg_l, 'start', wg_x.start, 'end', wg_x.stop))"
    by_label = f"flatten(transform(array_distinct(transform(`all`, wg_y -> wg_y.label)), wg_l -> {named}))"
    joined = notes.join(all_found.select("_key", F.expr(by_label).alias("_given")), F.col(key) == F.col("_key"), "left").drop("_key")
    none = "cast(array() AS array<struct<label:string,start:int,end:int>>)"
    return joined.withColumn("_given", F.coalesce("_given", F.expr(none)))


def wanted(text: str, label: str, labels: list[str] | None = None, stoplist: list[str] | None = None) -> str:
    """The label is wanted and the trimmed text is not in the stoplist (case matters)."""
    labels = ENTITY_LABELS if labels is None else labels
    stoplist = STOPLIST if stoplist is None else stoplist
    return f"({label} IN ({lits(labels)}) AND {strip(text)} NOT IN ({lits(stoplist)}))"


def filter_entity_spans(spans: DataFrame, labels: list[str] | None = None, stoplist: list[str] | None = None) -> DataFrame:
    """Keep spans of the wanted labels whose trimmed text is not in the stoplist."""
    return spans.filter(wanted("text", "label", labels, stoplist))


def is_name_like(
    text: str,
    label: str,
    stoplist: list[str] | None = None,
    *,
    short_capitals: bool = True,
    single_character: bool = True,
    digits: bool = True,
    lower_case: bool = True,
) -> str:
    """The filters against false names; each switch turns one of them off."""
    clean = "nl_c"  # trimmed once for all the tests
    tests = [f"{clean} NOT IN ({lits(STOPLIST if stoplist is None else stoplist)})"]
    if short_capitals:
        tests.append(f"NOT ({is_upper(clean)} AND length({clean}) <= 5)")
    if single_character:
        tests.append(f"length({clean}) > 1")
    if digits:
        tests.append(f"NOT {has_digit(clean)}")
    if lower_case:
        tests.append(f"NOT ({is_lower(clean)} AND {label} IN ('PERSON', 'ORG'))")
    return let(clean, strip(text), "(" + " AND ".join(tests) + ")")


def redacted_type(label: str) -> str:
    """PERSON, ORG or LOCATION; NULL for labels that are not redacted."""
    return f"CASE {label} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in LABEL_TO_TYPE.items()) + " END"


def filter_spans_smart(spans: DataFrame, stoplist: list[str] | None = None, **switches: bool) -> DataFrame:
    """Spans that will be redacted, with the ``type`` they are redacted as."""
    typed = spans.withColumn("type", F.expr(redacted_type("label")))
    return typed.filter(F.col("type").isNotNull()).filter(is_name_like("text", "label", stoplist, **switches))


def keep_redactable(tagged: str, stoplist: list[str] | None = None) -> str:
    """The redactable ones among ``tagged`` as spans ranked by their type."""
    kept = f"""filter({tagged}, kr_s -> {redacted_type('kr_s.label')} IS NOT NULL
      AND {is_name_like('kr_s.text', 'kr_s.label', stoplist)})"""
    rank = f"cast(array_position(array({lits(REDACTED_TYPES)}), {redacted_type('kr_x.label')}) - 1 AS int)"
    return f"transform({kept}, kr_x -> {S.span('kr_x.start', 'kr_x.`end`', rank)})"
