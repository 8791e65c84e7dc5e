"""The registered queries as DuckDB SQL, written independently of the Spark expressions.

Notes are ASCII, so RE2's word boundaries mean the same as ours.  RE2 has no lookahead: the
registration number is taken as a capturing group instead.
"""

from __future__ import annotations

from noteloom.functions.patterns import CLINICAL_PATTERNS, IDENTIFIER_PATTERNS
from noteloom.functions.vocabulary import BREEDS, DIAGNOSES, GAZETTEER, NOTE_LABELS, RAW_CANONICAL, STOPLIST, abbreviation_rows
from noteloom.plans import inputs


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(terms: list[str]) -> str:
    return "(" + ", ".join(map(quoted, terms)) + ")"


def values(terms: list[str]) -> str:
    return "(VALUES " + ", ".join(f"({quoted(t)}, {i})" for i, t in enumerate(terms)) + ")"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


CTE_NOTES = f"notes AS ({inputs.NOTES})"
CTE_SOURCE = f"source AS ({inputs.SOURCE})"


# --- patterns --------------------------------------------------------------------------------


def matches(pattern: str, name: str, source: str = "notes", flags: str = "(?i)") -> str:
    p = quoted(flags + pattern)
    return f"""SELECT record_id, '{name}' AS pattern, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS ord, unnest(m) AS raw
FROM (SELECT record_id, regexp_extract_all(raw_text, {p}, 0) AS m FROM {source}) WHERE len(m) > 0"""


CTE_PATTERNS = "patterns AS (" + "\nUNION ALL\n".join(matches(p, n) for n, p in CLINICAL_PATTERNS.items()) + ")"
CTE_VOCAB = "vocab AS (SELECT * FROM (VALUES " + ", ".join(
    f"({quoted(t)}, {quoted(c)}, {quoted(g)})" for t, c, g, _ in abbreviation_rows()
) + ") AS v(term, canonical, category))"
CTE_PARSED = r"""parsed AS (SELECT *, CASE WHEN num <> '' AND unit0 IS NOT NULL THEN CAST(num AS DOUBLE) END AS value,
  CASE WHEN num <> '' THEN unit0 END AS unit, CASE WHEN num <> '' AND unit0 IS NOT NULL THEN 'parsed' ELSE 'unmatched' END AS method
FROM (SELECT *, regexp_extract(raw, '\d+\.?\d*') AS num, CASE pattern
  WHEN 'age' THEN coalesce(nullif(regexp_extract(raw, '(?i)(years?|months?|wks?|weeks?|yo|yr)'), ''), 'unknown')
  WHEN 'temperature' THEN '°C'
  WHEN 'weight' THEN coalesce(nullif(lower(regexp_extract(raw, '(?i)(kg|lbs|g)')), ''), 'unknown')
  WHEN 'dosage' THEN coalesce(nullif(regexp_extract(raw, '(?i)(mg/kg|mg|ml|IU|mcg)'), ''), 'unknown') END AS unit0 FROM patterns))"""
CTE_STD = r"""std AS (SELECT p.record_id, p.pattern, p.ord, p.raw, coalesce(a.canonical, b.canonical) AS standard,
  coalesce(a.category, b.category) AS category,
  CASE WHEN a.term IS NULL AND b.term IS NULL THEN p.value END AS value,
  CASE WHEN a.term IS NULL AND b.term IS NULL THEN p.unit END AS unit,
  CASE WHEN a.term IS NOT NULL OR b.term IS NOT NULL THEN 'exact_match' ELSE p.method END AS method
FROM (SELECT *, coalesce(nullif(regexp_extract(raw, '^[A-Za-z]+'), ''), raw) AS k FROM parsed) p
LEFT JOIN vocab a ON upper(p.k) = a.term LEFT JOIN vocab b ON p.k = b.term)"""
BASE = [CTE_NOTES, CTE_PATTERNS]
STD = [*BASE, CTE_VOCAB, CTE_PARSED, CTE_STD]


# --- similarity ------------------------------------------------------------------------------


def lcs(a: str, b: str) -> str:
    """Longest common subsequence of two SQL expressions by a fold over the characters of ``a``."""
    full = f"((1::BIGINT << len({b})) - 1)"
    mask = (
        f"list_sum(list_transform(range(1, len({b}) + 1), lambda i: CASE WHEN substr({b}, i, 1) = ch THEN 1::BIGINT << (i - 1) ELSE 0 END))::BIGINT"
    )
    masks = f"list_transform(string_split({a}, ''), lambda ch: {mask})"
    fold = f"list_reduce({masks}, lambda x, m: ((x + (x & m)) | (x - (x & m))) & {full}, {full})"
    return f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE bit_count(~({fold}) & {full}) END)"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) + len({b}) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {lcs(a, b)} / (len({a}) + len({b})) END)"


def top1(terms: str, vocab: str, cutoff: float) -> str:
    """Best vocabulary entry per distinct term by plain ratio."""
    return f"""best AS (SELECT t.term, arg_max(v.term, (s, -v.ord)) AS matched, max(s) AS score FROM (
  SELECT t.term, v.term AS vterm, v.ord, {ratio('t.term', 'v.term')} AS s FROM {terms} t CROSS JOIN {vocab} AS v(term, ord)
  WHERE len(t.term) >= 4) x JOIN {terms} t ON t.term = x.term JOIN {vocab} AS v(term, ord) ON v.ord = x.ord
  WHERE s >= {cutoff} GROUP BY t.term)"""


def ngrams(text: str) -> str:
    code = "((ascii(substr(p, i, 1))::BIGINT * 31 + ascii(substr(p, i + 1, 1))) * 31 + ascii(substr(p, i + 2, 1))) % 64"
    codes = f"list_transform([' ' || lower({text}) || ' '], lambda p: list_transform(range(1, len(p) - 1), lambda i: {code}))"
    return f"list_transform({codes}, lambda c: list_transform(range(0, 64), lambda d: len(list_filter(c, lambda b: b = d))::DOUBLE))[1]"


CTE_DIAG = f"diag AS (SELECT term, ord, {ngrams('term')} AS vec FROM {values(DIAGNOSES)} AS d(term, ord))"


def cascade_ctes(threshold: float = 0.5) -> list[str]:
    """From ``spans(record_id, ord, term)`` to ``matched(term, standard, score, method)``."""
    return [
        CTE_DIAG,
        "terms AS (SELECT term, count(*) AS n FROM spans GROUP BY term)",
        "exact AS (SELECT t.term, coalesce(a.canonical, b.canonical) AS standard FROM terms t LEFT JOIN vocab a ON upper(t.term) = a.term LEFT JOIN vocab b ON t.term = b.term)",
        f"""fuzzy AS (SELECT term, arg_max(cand, (s, -ord)) AS standard, max(s) AS score FROM (
  SELECT t.term, d.term AS cand, d.ord, {ratio('t.term', 'd.term')} AS s FROM terms t CROSS JOIN diag d
  WHERE len(t.term) >= 4 AND t.term IN (SELECT term FROM exact WHERE standard IS NULL)) WHERE s >= 85 GROUP BY term)""",
        f"""semantic AS (SELECT term, arg_max(cand, (s, -ord)) AS standard, max(s) AS score FROM (
  SELECT t.term, d.term AS cand, d.ord, list_cosine_similarity(t.vec, d.vec) AS s
  FROM (SELECT term, {ngrams('term')} AS vec FROM exact WHERE standard IS NULL AND term NOT IN (SELECT term FROM fuzzy)) t CROSS JOIN diag d)
  WHERE s >= {threshold} GROUP BY term)""",
        """matched AS (SELECT t.term, t.n, coalesce(e.standard, f.standard, s.standard, t.term) AS standard, coalesce(f.score, s.score) AS score,
  CASE WHEN e.standard IS NOT NULL THEN 'exact_match' WHEN f.term IS NOT NULL THEN 'fuzzy_match' WHEN s.term IS NOT NULL THEN 'semantic_match' ELSE 'unmatched' END AS method
FROM terms t JOIN exact e ON t.term = e.term LEFT JOIN fuzzy f ON t.term = f.term LEFT JOIN semantic s ON t.term = s.term)""",
    ]


CTE_SPANS = "spans AS (SELECT record_id, 0::BIGINT AS ord, disease AS term FROM notes WHERE disease IS NOT NULL)"
CTE_DX = "dx AS (SELECT record_id, 'diagnoses' AS pattern, ord, s.term AS raw, standard, score, method FROM spans s JOIN matched m ON s.term = m.term)"
ITEMS = [*STD, CTE_SPANS, *cascade_ctes(), CTE_DX,
         "items AS (SELECT pattern, value, unit, method FROM std UNION ALL SELECT pattern, NULL, NULL, method FROM dx)"]


CTE_DX_ONLY = "x AS (SELECT record_id, CASE WHEN method <> 'unmatched' THEN standard END AS standard, method FROM dx)"


def weighted_ctes(vocab: str) -> list[str]:
    """Weighted ratio of every pair of ``terms`` and the vocabulary, step by step."""

    def sorted_words(words: str) -> str:
        return f"array_to_string(list_sort({words}), ' ')"

    def windows(short: str, long: str) -> str:
        start, end = "greatest(i, 1)", f"least(i + len({short}) - 1, len({long}))"
        window = f"substr({long}, {start}, {end} - {start} + 1)"
        score = f"200.0::DOUBLE * {lcs(window, short)} / (len({short}) + {end} - {start} + 1)"
        return f"list_max(list_transform(range(2 - len({short}), len({long}) + 1), lambda i: {score}))"

    def partial(a: str, b: str) -> str:
        return f"""(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 100.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0
  WHEN len({a}) < len({b}) THEN {windows(a, b)} WHEN len({b}) < len({a}) THEN {windows(b, a)}
  ELSE greatest({windows(a, b)}, {windows(b, a)}) END)"""

    wa, wb = "string_split(a, ' ')", "string_split(b, ' ')"
    return [
        f"vocabulary AS ({vocab})",
        f"""pairs AS (SELECT t.term AS a, v.term AS b, v.ord, {wa.replace('a,', 't.term,')} AS wa, {wb.replace('b,', 'v.term,')} AS wb
  FROM terms t CROSS JOIN vocabulary v WHERE len(t.term) >= 4)""",
        f"""parts AS (SELECT *, {sorted_words('wa')} AS sa, {sorted_words('wb')} AS sb, list_distinct(wa) AS da, list_distinct(wb) AS db,
  greatest(len(a), len(b))::DOUBLE / least(len(a), len(b)) AS spread FROM pairs)""",
        f"""sets AS (SELECT *, {sorted_words('list_intersect(da, db)')} AS both_words,
  {sorted_words('list_filter(da, lambda w: NOT list_contains(db, w))')} AS only_a,
  {sorted_words('list_filter(db, lambda w: NOT list_contains(da, w))')} AS only_b,
  {sorted_words('da')} AS ua, {sorted_words('db')} AS ub FROM parts)""",
        f"""basic AS (SELECT *, {ratio('a', 'b')} AS plain, len(both_words) AS k, CASE WHEN both_words = '' THEN 0 ELSE 1 END AS glue,
  CASE WHEN spread < 1.5 THEN {ratio('sa', 'sb')} ELSE 0 END AS tsort,
  CASE WHEN spread < 1.5 THEN len(only_a) + len(only_b) - 2 * {lcs('only_a', 'only_b')} END AS dist FROM sets)""",
        """token AS (SELECT *, CASE WHEN spread >= 1.5 THEN 0
  WHEN glue = 1 AND (only_a = '' OR only_b = '') THEN 100.0
  ELSE greatest(100 - 100.0::DOUBLE * dist / (2 * (k + glue) + len(only_a) + len(only_b)),
    CASE WHEN glue = 1 THEN 100 - 100.0::DOUBLE * (1 + len(only_a)) / (2 * k + 1 + len(only_a)) ELSE 0 END,
    CASE WHEN glue = 1 THEN 100 - 100.0::DOUBLE * (1 + len(only_b)) / (2 * k + 1 + len(only_b)) ELSE 0 END) END AS tset FROM basic)""",
        f"""partials AS (SELECT *, CASE WHEN spread >= 1.5 THEN {partial('a', 'b')} ELSE 0 END AS part,
  CASE WHEN spread < 1.5 THEN 0 WHEN glue = 1 THEN 100.0 WHEN sa <> ua OR sb <> ub THEN greatest({partial('sa', 'sb')}, {partial('ua', 'ub')})
  ELSE {partial('sa', 'sb')} END AS ptoken FROM token)""",
        """scored AS (SELECT a, b, ord, CASE WHEN spread < 1.5 THEN greatest(plain, 0.95::DOUBLE * greatest(tsort, tset))
  WHEN spread <= 8 THEN greatest(plain, 0.9::DOUBLE * part, 0.95::DOUBLE * 0.9::DOUBLE * ptoken)
  ELSE greatest(plain, 0.6::DOUBLE * part, 0.95::DOUBLE * 0.6::DOUBLE * ptoken) END AS s FROM partials)""",
        "best AS (SELECT a AS term, arg_max(b, (s, -ord)) AS matched, max(s) AS score FROM scored WHERE s >= 75 GROUP BY a)",
    ]


TERM_RESULT = "SELECT t.term, t.n, b.matched, round(b.score, 6) AS score FROM terms t LEFT JOIN best b ON t.term = b.term"


# --- identifiers -----------------------------------------------------------------------------

DUCK_IDENTIFIERS = {
    **{k: (v, 0) for k, v in IDENTIFIER_PATTERNS.items()},
    "ID": (r"\b(\d{5,7}[A-Z]?)\b\s*MRCVS", 1),
}


def located(kind: str, rank: int, source: str, key: str, text: str) -> str:
    pattern, group = DUCK_IDENTIFIERS[kind]
    p = quoted(pattern)
    return f"""SELECT {key}, type, rank, full_start AS start, full_start + len(value) AS "end", value AS text FROM (
  SELECT {key}, '{kind}' AS type, {rank} AS rank, g[i] AS value,
    list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS full_start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT {key}, regexp_extract_all({text}, {p}, 0) AS m, regexp_extract_all({text}, {p}, {group}) AS g,
      regexp_split_to_array({text}, {p}) AS gaps FROM {source})))"""


def pii_cte(source: str = "notes", key: str = "record_id", text: str = "raw_text", kinds: list[str] | None = None, name: str = "pii") -> str:
    kinds = kinds or list(DUCK_IDENTIFIERS)
    order = list(DUCK_IDENTIFIERS)
    return f"{name} AS (" + "\nUNION ALL\n".join(located(k, order.index(k), source, key, text) for k in kinds) + ")"


def redaction_ctes(spans: str, source: str, text: str, prefix: str, by_rank: bool) -> list[str]:
    """Merge (gaps and islands), number and replace the spans of ``source.text``.

    Gives ``{prefix}_entities`` and ``{prefix}_done(record_id, redacted)``.
    """
    order = "rank, start" if by_rank else "start"
    p = prefix
    return [
        f"""{p}_marked AS (SELECT *, CASE WHEN start >= coalesce(max("end") OVER (PARTITION BY record_id ORDER BY start, "end" DESC, rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS opens FROM {spans})""",
        f"""{p}_islands AS (SELECT *, sum(opens) OVER (PARTITION BY record_id ORDER BY start, "end" DESC, rank ROWS UNBOUNDED PRECEDING) AS island FROM {p}_marked)""",
        f"""{p}_merged AS (SELECT record_id, island, min(start) AS start, max("end") AS "end",
  arg_min(rank, (start, -"end", rank)) AS rank, arg_min(type, (start, -"end", rank)) AS type FROM {p}_islands GROUP BY record_id, island)""",
        f"""{p}_valued AS (SELECT m.*, substr(n.{text}, m.start::BIGINT + 1, (m."end" - m.start)::BIGINT) AS text,
  row_number() OVER (PARTITION BY m.record_id ORDER BY {order}) - 1 AS seq FROM {p}_merged m JOIN {source} n ON m.record_id = n.record_id)""",
        f"""{p}_first AS (SELECT record_id, text, min(seq) AS seen, arg_min(type, seq) AS ftype FROM {p}_valued GROUP BY record_id, text)""",
        f"""{p}_names AS (SELECT *, '[' || ftype || '_' || CAST(row_number() OVER (PARTITION BY record_id, ftype ORDER BY seen) AS VARCHAR) || ']' AS placeholder FROM {p}_first)""",
        f"""{p}_entities AS (SELECT v.record_id, v.seq, v.type, v.text, v.start, v."end", n.placeholder FROM {p}_valued v
  JOIN {p}_names n ON v.record_id = n.record_id AND v.text = n.text)""",
        f"""{p}_pieces AS (SELECT e.record_id, e.start, e."end",
  substr(n.{text}, coalesce(lag(e."end") OVER w, 0)::BIGINT + 1, (e.start - coalesce(lag(e."end") OVER w, 0))::BIGINT) || placeholder AS piece
  FROM {p}_entities e JOIN {source} n ON e.record_id = n.record_id WINDOW w AS (PARTITION BY e.record_id ORDER BY e.start))""",
        f"""{p}_done AS (SELECT n.record_id, CASE WHEN j.record_id IS NULL THEN n.{text} ELSE j.body || substr(n.{text}, j.last::BIGINT + 1) END AS redacted
  FROM {source} n LEFT JOIN (SELECT record_id, string_agg(piece, '' ORDER BY start) AS body, max("end") AS last FROM {p}_pieces GROUP BY record_id) j
  ON n.record_id = j.record_id)""",
    ]


# --- entities --------------------------------------------------------------------------------

_CAP = r"[\p{Lu}][\p{L}'’-]+"
_MONTHS = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"


def names_pattern(names: list[str]) -> str:
    return r"\b(" + "|".join(sorted(names, key=lambda n: (-len(n), n))) + r")\b"


CUES = [
    ("PERSON", rf"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof)\.? ({_CAP}(?: {_CAP})*)"),
    ("DATE", rf"(\b\d{{1,2}}[ -]{_MONTHS}(?:[ -]\d{{2,4}})?\b|\b{_MONTHS} \d{{4}}\b)"),
    *[(label, names_pattern(names)) for label, names in GAZETTEER.items()],
]


def tagged_cte(source: str, text: str, name: str = "tagged") -> str:
    """Cue matches; in the notes no two of them overlap and none touches a placeholder."""
    parts = []
    for i, (label, pattern) in enumerate(CUES):
        p = quoted(pattern)
        parts.append(f"""SELECT record_id, '{label}' AS label, {i} AS cue, pos + len(whole) - len(value) AS start, pos + len(whole) AS "end", value AS text FROM (
  SELECT record_id, m[i] AS whole, g[i] AS value,
    list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS pos
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT record_id, regexp_extract_all({text}, {p}, 0) AS m, regexp_extract_all({text}, {p}, 1) AS g,
      regexp_split_to_array({text}, {p}) AS gaps FROM {source})))""")
    return f"{name} AS (" + "\nUNION ALL\n".join(parts) + ")"


TYPE_OF = "CASE label WHEN 'PERSON' THEN 'PERSON' WHEN 'ORG' THEN 'ORG' WHEN 'GPE' THEN 'LOCATION' WHEN 'LOC' THEN 'LOCATION' END"
SMART = rf"""trim(text) NOT IN {in_list(STOPLIST)} AND NOT (upper(trim(text)) = trim(text) AND lower(trim(text)) <> trim(text) AND len(trim(text)) <= 5)
  AND len(trim(text)) > 1 AND NOT regexp_matches(trim(text), '\d')
  AND NOT (lower(trim(text)) = trim(text) AND upper(trim(text)) <> trim(text) AND label IN ('PERSON', 'ORG'))"""


def redactable_cte(source: str = "tagged", name: str = "named") -> str:
    return f"""{name} AS (SELECT record_id, type, CASE type WHEN 'PERSON' THEN 0 WHEN 'ORG' THEN 1 ELSE 2 END AS rank, start, "end"
  FROM (SELECT *, {TYPE_OF} AS type FROM {source} WHERE {SMART}) WHERE type IS NOT NULL)"""


_LABEL_LIST = "[" + ", ".join(map(quoted, inputs.GIVEN_LABELS)) + "]"
CTE_GIVEN = f"""given AS (SELECT record_id, ord, text, {_LABEL_LIST}[(record_id + ord) % {len(inputs.GIVEN_LABELS)} + 1] AS label FROM (
  SELECT record_id, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS ord, unnest(m) AS text
  FROM (SELECT record_id, regexp_extract_all(raw_text, {quoted(inputs.WORDS)}, 0) AS m FROM notes)))"""

STRUCTURED = [CTE_NOTES, pii_cte(), *redaction_ctes("pii", "notes", "raw_text", "s", True)]
CHAIN = [
    *STRUCTURED,
    tagged_cte("s_done", "redacted"),
    redactable_cte(),
    *redaction_ctes("named", "s_done", "redacted", "e", False),
]


# --- privacy ---------------------------------------------------------------------------------


def first_or_unknown(pattern: str) -> str:
    return f"coalesce(nullif(regexp_extract(raw_text, {quoted('(?i)' + CLINICAL_PATTERNS[pattern])}, 0), ''), 'unknown')"


CTE_KEYS = f"keyed AS (SELECT record_id, {first_or_unknown('age')} AS age, {first_or_unknown('weight')} AS weight, {first_or_unknown('sex_neuter')} AS sex FROM notes)"
CTE_GROUPS = "grp AS (SELECT age, weight, sex, count(*) AS n_records FROM keyed GROUP BY age, weight, sex)"
AGE_BAND = r"""(CASE WHEN regexp_extract(age, '\d+') = '' THEN 'unknown' WHEN regexp_matches(lower(age), 'month|wk|week') THEN 'juvenile'
  WHEN regexp_extract(age, '\d+')::BIGINT <= 2 THEN '0-2 years' WHEN regexp_extract(age, '\d+')::BIGINT <= 5 THEN '3-5 years'
  WHEN regexp_extract(age, '\d+')::BIGINT <= 10 THEN '6-10 years' ELSE '11+ years' END)"""
_W = r"regexp_extract(weight, '\d+\.?\d*')"
WEIGHT_BAND = f"""(CASE WHEN {_W} = '' THEN 'unknown' WHEN {_W}::DOUBLE < 5 THEN '0-5kg' WHEN {_W}::DOUBLE < 10 THEN '5-10kg'
  WHEN {_W}::DOUBLE < 20 THEN '10-20kg' WHEN {_W}::DOUBLE < 40 THEN '20-40kg' ELSE '40+kg' END)"""
KEYS = [CTE_NOTES, CTE_KEYS, CTE_GROUPS]
CTE_MITIGATED = f"""mit AS (SELECT k.record_id, CASE WHEN n_records < 5 AND k.age <> 'unknown' THEN {AGE_BAND.replace('(age', '(k.age')} ELSE k.age END AS age,
  CASE WHEN n_records < 5 AND k.weight <> 'unknown' THEN {WEIGHT_BAND.replace('(weight', '(k.weight')} ELSE k.weight END AS weight, k.sex, g.n_records
  FROM keyed k JOIN grp g ON k.age = g.age AND k.weight = g.weight AND k.sex = g.sex)"""


def summary(groups: str, stage: str | None = None) -> str:
    tail = "" if stage is None else f", '{stage}' AS stage"
    return f"""SELECT count(*) AS n_groups, count(*) FILTER (n_records < 5) AS risky_groups, coalesce(sum(n_records), 0)::BIGINT AS n_records,
  coalesce(sum(n_records) FILTER (n_records < 5), 0)::BIGINT AS records_at_risk{tail} FROM {groups}"""


def all_of(pattern: str) -> str:
    return f"regexp_extract_all(raw_text, {quoted('(?i)' + CLINICAL_PATTERNS[pattern])}, 0)"


# --- evaluation and quality ------------------------------------------------------------------

EVAL = [
    *CHAIN,
    "g AS (SELECT DISTINCT record_id, lower(unnest(string_split(gold, '|'))) AS g FROM notes WHERE gold <> '')",
    "f AS (SELECT DISTINCT record_id, lower(text) AS f FROM (SELECT record_id, text FROM s_entities UNION ALL SELECT record_id, text FROM e_entities))",
    "gm AS (SELECT g.record_id, g.g, coalesce(bool_or(contains(f.f, g.g) OR contains(g.g, f.f)), false) AS hit FROM g LEFT JOIN f ON g.record_id = f.record_id GROUP BY g.record_id, g.g)",
    "fm AS (SELECT f.record_id, f.f, bool_or(contains(f.f, g.g) OR contains(g.g, f.f)) AS hit FROM f JOIN g ON g.record_id = f.record_id GROUP BY f.record_id, f.f)",
    """ev AS (SELECT a.record_id, a.tp, a.fn, coalesce(b.fp, 0)::BIGINT AS fp FROM
  (SELECT record_id, count(*) FILTER (hit) AS tp, count(*) FILTER (NOT hit) AS fn FROM gm GROUP BY record_id) a
  LEFT JOIN (SELECT record_id, count(*) FILTER (NOT hit) AS fp FROM fm GROUP BY record_id) b ON a.record_id = b.record_id)""",
]

COMPLETE = "(count(*) FILTER (len(raw_text) > 0) + count(*) FILTER (icd <> '') + count(*) FILTER (disease IS NOT NULL))"
Q_COMPLETE = f"SELECT 'Completeness' AS dimension, {COMPLETE}::DOUBLE / (3 * count(*)) AS before, ({COMPLETE} + 3 * count(*))::DOUBLE / (6 * count(*)) AS after FROM notes"
WORDS2 = r"(SELECT unnest(regexp_extract_all(raw_text, '\b[A-Z]{2,5}\b', 0)) AS w FROM notes)"


def raw_accuracy(terms: list[str]) -> str:
    return f"(SELECT coalesce(count(*) FILTER (w IN {in_list(terms)})::DOUBLE / nullif(count(*), 0), 0.0) FROM {WORDS2})"


ACCURATE = "avg(CASE WHEN pattern = 'diagnoses' THEN (method <> 'unmatched')::INT ELSE (method IN ('exact_match', 'parsed'))::INT END)"
STANDARD = "avg((method IN ('exact_match', 'fuzzy_match', 'semantic_match', 'zero_shot', 'parsed'))::INT)"
IN_RANGE = """coalesce(avg(CASE pattern WHEN 'weight' THEN (value BETWEEN 0.1 AND 100)::INT WHEN 'temperature' THEN (value BETWEEN 35 AND 42)::INT
  ELSE (value > 0 AND value <= 30)::INT END) FILTER (pattern IN ('weight', 'temperature', 'age') AND value IS NOT NULL), 0.5)"""


def validity(items: str) -> str:
    return f"""SELECT 'Validity' AS dimension, (SELECT avg((len(raw_text) > 5)::INT) FROM notes) AS before,
  (SELECT (count(*) FILTER (len(raw_text) > 5) + (SELECT count(*) FILTER (value IS NOT NULL AND (pattern = 'temperature' OR unit IS NOT NULL)) FROM {items} WHERE pattern IN ('weight', 'temperature', 'age')))::DOUBLE
    / (count(*) + (SELECT count(*) FROM {items} WHERE pattern IN ('weight', 'temperature', 'age'))) FROM notes) AS after"""


def unique(source: str, column: str) -> str:
    share = f"(count(DISTINCT {column}) + max(({column} IS NULL)::INT))::DOUBLE / count(*)"
    return f"SELECT 'Uniqueness' AS dimension, {share} AS before, {share} AS after FROM {source}"


SIX = f"""six AS ({Q_COMPLETE}
UNION ALL SELECT 'Accuracy', {raw_accuracy(RAW_CANONICAL)}, (SELECT {ACCURATE} FROM items)
UNION ALL SELECT 'Consistency', 0.5, (SELECT {IN_RANGE} FROM items)
UNION ALL {validity('items')}
UNION ALL {unique('notes', 'raw_text')}
UNION ALL SELECT 'Standardisation', 0.0, (SELECT {STANDARD} FROM items))"""


def rounded_scores(inner: str) -> str:
    return f"SELECT dimension, round(before::DOUBLE, 6) AS before, round(after::DOUBLE, 6) AS after FROM ({inner})"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    notes = with_(CTE_NOTES)
    out["scan_notes"] = notes + "SELECT record_id, raw_text, disease FROM notes"

    kinds = """CASE WHEN disease IS NULL OR record_id % 5 = 2 THEN []
  WHEN record_id % 5 = 0 THEN [{'entity': disease, 'label': NULL::VARCHAR, 's': NULL::BIGINT, 'e': NULL::BIGINT}]
  WHEN record_id % 5 = 1 THEN [{'entity': disease, 'label': NULL, 's': 3, 'e': NULL}]
  ELSE [{'entity': disease, 'label': NULL, 's': 3, 'e': 9}, {'entity': 'owner''s word: None', 'label': 'X', 's': NULL, 'e': NULL}] END"""
    out["parse_annotations"] = notes + f"""SELECT record_id, ord, s.entity AS entity, s.label AS label, s.s AS start, s.e AS "end" FROM (
  SELECT record_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS ord, unnest(l) AS s FROM (SELECT record_id, {kinds} AS l FROM notes) WHERE len(l) > 0)"""
    out["shape_records"] = notes + f"""SELECT record_id, raw_text, CASE WHEN icd = '' THEN '' ELSE icd || '|it''s other' END AS icd_labels,
  gold AS anon_spans, len({kinds}) AS n_disease_spans FROM notes"""
    out["vocab_by_category"] = with_(*STD) + """SELECT v.category, v.n_terms, coalesce(h.n_hits, 0) AS n_hits FROM
  (SELECT category, count(*) AS n_terms FROM vocab GROUP BY category) v LEFT JOIN
  (SELECT category, count(*) AS n_hits FROM std WHERE method = 'exact_match' GROUP BY category) h ON v.category = h.category"""

    for name in CLINICAL_PATTERNS:
        out[f"extract_{name}"] = notes + matches(CLINICAL_PATTERNS[name], name)
    out["extract_patterns_long"] = with_(*BASE) + "SELECT * FROM patterns"
    out["filter_entity_spans"] = with_(CTE_NOTES, CTE_GIVEN) + f"""SELECT record_id, ord, text, label FROM given
WHERE label IN ('PERSON', 'ORG', 'GPE', 'LOC', 'DATE') AND trim(text) NOT IN {in_list(STOPLIST)}"""
    out["tag_entities"] = with_(CTE_NOTES, tagged_cte("notes", "raw_text")) + """SELECT record_id, text, label, start::BIGINT AS start, "end"::BIGINT AS "end" FROM tagged"""
    out["extract_all"] = with_(*BASE, tagged_cte("notes", "raw_text")) + f"""SELECT n.record_id, coalesce(t.n, 0) AS n_entities, coalesce(p.k, 0) AS n_patterns, coalesce(p.n, 0) AS n_matches FROM notes n
LEFT JOIN (SELECT record_id, count(*) AS n FROM tagged WHERE trim(text) NOT IN {in_list(STOPLIST)} GROUP BY record_id) t ON n.record_id = t.record_id
LEFT JOIN (SELECT record_id, count(*) AS n, count(DISTINCT pattern) AS k FROM patterns GROUP BY record_id) p ON n.record_id = p.record_id"""

    out["standardise_exact"] = with_(*STD) + "SELECT record_id, pattern, ord, raw, standard, category, round(value, 6) AS value, unit, method FROM std"
    out["parse_values"] = with_(*BASE, CTE_PARSED) + "SELECT record_id, pattern, ord, raw, round(value, 6) AS value, unit, method FROM parsed"
    out["pattern_methods"] = with_(*STD) + "SELECT pattern, method, count(*) AS n FROM std GROUP BY pattern, method"
    out["fuzzy_match_diagnosis"] = with_(
        f"terms AS (SELECT term, count(*) AS n FROM ({inputs.MISSPELT_DIAGNOSES}) GROUP BY term)", top1("terms", values(DIAGNOSES), 85)
    ) + TERM_RESULT
    out["fuzzy_match_weighted"] = with_(
        f"terms AS (SELECT term, count(*) AS n FROM ({inputs.MISSPELT_BREEDS}) GROUP BY term)",
        *weighted_ctes(f"SELECT * FROM {values(BREEDS)} AS v(term, ord)"),
    ) + TERM_RESULT
    out["fuzzy_match_parts"] = with_(
        f"terms AS (SELECT term, count(*) AS n FROM ({inputs.MISSPELT_PARTS}) GROUP BY term)",
        *weighted_ctes("SELECT p_name AS term, min(p_partkey) AS ord FROM part GROUP BY p_name"),
    ) + TERM_RESULT
    near = [
        """means AS (SELECT label, list(x ORDER BY i) AS vec FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS x
  FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)""",
        """near AS (SELECT vec_id, arg_max(label, (s, -label)) AS label, max(s) AS score FROM (
  SELECT e.vec_id, m.label, list_cosine_similarity(list_transform(e.embedding, lambda x: x::DOUBLE), m.vec) AS s FROM embeddings e CROSS JOIN means m) GROUP BY vec_id)""",
    ]
    out["semantic_match"] = with_(*near) + """SELECT vec_id, CASE WHEN score >= 0.22 THEN 'label ' || label END AS matched,
  CASE WHEN score >= 0.22 THEN round(score, 6) END AS score FROM near"""
    out["label_top1"] = with_(*near) + "SELECT vec_id, 'label ' || label AS label, round(score, 6) AS score FROM near WHERE score >= 0.2"
    out["label_top1_scores"] = """WITH s AS (SELECT user_id, event_type, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id) AS score FROM events GROUP BY user_id, event_type),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, ascii(event_type), event_type DESC) AS rn FROM s)
SELECT user_id, event_type AS label, round(score, 6) AS score FROM r WHERE rn = 1 AND score >= 0.25"""
    out["cascade_vectors"] = with_(*near) + """SELECT vec_id AS record_id, 'item ' || vec_id AS raw,
  CASE WHEN score >= 0.22 THEN 'label ' || label ELSE 'item ' || vec_id END AS standard, CASE WHEN score >= 0.22 THEN round(score, 6) END AS score,
  CASE WHEN score >= 0.22 THEN 'semantic_match' ELSE 'unmatched' END AS method FROM near"""
    dx = [CTE_NOTES, CTE_VOCAB, CTE_SPANS, *cascade_ctes()]
    out["cascade_diagnoses"] = with_(*dx, CTE_DX) + "SELECT record_id, pattern, ord, raw, standard, round(score, 6) AS score, method FROM dx"
    out["cascade_misspelt"] = with_(
        CTE_VOCAB, f"spans AS (SELECT record_id, 0::BIGINT AS ord, term FROM ({inputs.MISSPELT_DIAGNOSES}))", *cascade_ctes(), CTE_DX
    ) + "SELECT record_id, raw, standard, round(score, 6) AS score, method FROM dx"
    out["cascade_dictionary"] = out["cascade_misspelt"]
    out["round_trip_records"] = out["shape_records"]
    out["semantic_match_parts"] = with_(
        f"terms AS (SELECT term, count(*) AS n, {ngrams('term')} AS vec FROM ({inputs.MISSPELT_PARTS}) GROUP BY term)",
        f"parts AS (SELECT p_name AS part, min(p_partkey) AS ord, {ngrams('p_name')} AS vec FROM part GROUP BY p_name)",
        "s AS (SELECT t.term, t.n, p.part, p.ord, list_cosine_similarity(t.vec, p.vec) AS s FROM terms t CROSS JOIN parts p)",
    ) + """SELECT term, n, CASE WHEN max(s) >= 0.62 THEN arg_max(part, (round(s, 12), -ord)) END AS matched,
  CASE WHEN max(s) >= 0.62 THEN round(max(s), 6) END AS score FROM s GROUP BY term, n"""
    centroids = [
        CTE_NOTES,
        r"""words AS (SELECT record_id, disease, word, count(*) AS n FROM (
  SELECT record_id, disease, unnest(regexp_extract_all(lower(raw_text), '[\p{L}\p{N}_]+')) AS word FROM notes) GROUP BY ALL)""",
        """weights AS (SELECT word, ln((1.0 + (SELECT count(DISTINCT record_id) FROM words WHERE disease IS NOT NULL)) / (1.0 + count(*))) AS w
  FROM words WHERE disease IS NOT NULL GROUP BY word)""",
        "raw AS (SELECT record_id, disease, word, n * w AS x FROM words JOIN weights USING (word) WHERE w > 0)",
        "vecs AS (SELECT r.record_id, r.disease, r.word, r.x / l.len AS x FROM raw r JOIN (SELECT record_id, sqrt(sum(x * x)) AS len FROM raw GROUP BY record_id) l USING (record_id))",
        "sums AS (SELECT disease AS label, word, sum(x) AS x FROM vecs WHERE disease IS NOT NULL GROUP BY disease, word)",
        "cent AS (SELECT s.label, s.word, s.x / l.len AS x FROM sums s JOIN (SELECT label, sqrt(sum(x * x)) AS len FROM sums GROUP BY label) l USING (label))",
        "labelled AS (SELECT v.record_id, c.label, sum(v.x * c.x) AS score FROM vecs v JOIN cent c USING (word) WHERE v.disease IS NULL GROUP BY v.record_id, c.label)",
    ]
    out["label_centroid_scores"] = with_(*centroids) + "SELECT record_id, label, round(score, 6) AS score FROM labelled"
    out["fallback_centroids"] = with_(*centroids) + """SELECT record_id, arg_max(label, (score, -ascii(label), label)) AS standard, round(max(score), 6) AS score, 'zero_shot' AS method
FROM labelled GROUP BY record_id HAVING max(score) >= 0.05"""
    out["fallback_label"] = with_(
        CTE_NOTES,
        f"labels AS (SELECT term, ord, {ngrams('term')} AS vec FROM {values(NOTE_LABELS)} AS d(term, ord))",
        f"bare AS (SELECT record_id, {ngrams('raw_text')} AS vec FROM notes WHERE disease IS NULL)",
        "s AS (SELECT b.record_id, l.term, l.ord, list_cosine_similarity(b.vec, l.vec) AS s FROM bare b CROSS JOIN labels l)",
    ) + """SELECT record_id, arg_max(term, (s, -ord)) AS standard, round(max(s), 6) AS score, 'zero_shot' AS method FROM s GROUP BY record_id HAVING max(s) >= 0.2"""
    out["standardised_long"] = with_(*STD, CTE_SPANS, *cascade_ctes(), CTE_DX) + """SELECT record_id, pattern, ord, raw, standard, category, round(value, 6) AS value, unit, NULL::DOUBLE AS score, method FROM std
UNION ALL SELECT record_id, pattern, ord, raw, standard, NULL, NULL, NULL, round(score, 6), method FROM dx"""
    labelled = out["fallback_label"].removeprefix("WITH ")
    out["standardise_fallback"] = f"""SELECT * FROM ({out["standardised_long"]}) UNION ALL
SELECT record_id, 'diagnoses', 0, NULL, standard, NULL, NULL, NULL, score, method FROM (WITH {labelled})"""
    out["standardised_map_items"] = f"""WITH long AS ({out["standardised_long"]}), bare AS (SELECT DISTINCT record_id FROM long EXCEPT SELECT record_id FROM long WHERE pattern = 'diagnoses')
SELECT record_id, pattern, row_number() OVER (PARTITION BY record_id, pattern ORDER BY ord) - 1 AS pos, raw, standard, category, value, unit, score, method FROM long
UNION ALL SELECT record_id, 'diagnoses', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM bare"""
    out["method_distribution"] = with_(*dx) + "SELECT method, sum(n)::BIGINT AS n FROM matched GROUP BY method"

    names = {"PHONE": "pii_phone", "EMAIL": "pii_email", "POSTCODE": "pii_postcode", "MICROCHIP": "pii_microchip", "DATE": "pii_date", "ID": "pii_registration_id"}
    for kind, name in names.items():
        out[name] = with_(CTE_NOTES, pii_cte(kinds=[kind])) + """SELECT record_id, text, start::BIGINT AS start, "end"::BIGINT AS "end" FROM pii"""
    out["pii_email_documents"] = with_(pii_cte("documents", "doc_id", "text", ["EMAIL"])) + """SELECT doc_id, text, start::BIGINT AS start, "end"::BIGINT AS "end" FROM pii"""
    out["pii_conversations"] = with_(
        """turns AS (SELECT conv_id * 1000 + turn AS turn_id, text || CASE conv_id % 3 WHEN 0 THEN ' Mail user.' || conv_id || '@example.org, M1 1AA'
  WHEN 1 THEN ' on 01/0' || (turn % 9 + 1) || '/2024' ELSE '' END AS body FROM conversations)""", pii_cte("turns", "turn_id", "body")
    ) + """SELECT turn_id, type, text, start::BIGINT AS start, "end"::BIGINT AS "end" FROM pii"""
    out["pii_documents"] = with_(pii_cte("documents", "doc_id", "text")) + """SELECT doc_id, type, text, start::BIGINT AS start, "end"::BIGINT AS "end" FROM pii"""
    found = with_(CTE_NOTES, pii_cte())
    out["pii_spans"] = found + """SELECT record_id, type, text, start::BIGINT AS start, "end"::BIGINT AS "end" FROM pii"""
    out["pii_counts"] = found + "SELECT type, count(*) AS n_matches, count(DISTINCT text) AS n_values FROM pii GROUP BY type"
    entity = """record_id, seq AS ord, type, text, start::BIGINT AS start, "end"::BIGINT AS "end", placeholder"""
    out["pii_placeholders"] = with_(*STRUCTURED) + f"SELECT {entity} FROM s_entities"
    out["redact_structured"] = with_(*STRUCTURED) + "SELECT record_id, redacted AS redacted_text FROM s_done"
    out["filter_spans_smart"] = with_(CTE_NOTES, CTE_GIVEN) + f"SELECT * FROM (SELECT record_id, ord, text, label, {TYPE_OF} AS type FROM given WHERE {SMART}) WHERE type IS NOT NULL"
    out["redact_entities"] = with_(
        CTE_NOTES, tagged_cte("notes", "raw_text"), redactable_cte(), *redaction_ctes("named", "notes", "raw_text", "e", False)
    ) + """SELECT d.record_id, d.redacted AS redacted_text, coalesce(c.n, 0) AS n_entities FROM e_done d
LEFT JOIN (SELECT record_id, count(*) AS n FROM e_entities GROUP BY record_id) c ON d.record_id = c.record_id"""
    out["deidentify_notes"] = with_(*CHAIN) + """SELECT d.record_id, d.redacted AS redacted_text, coalesce(s.n, 0) + coalesce(e.n, 0) AS n_entities, coalesce(s.n, 0) AS n_structured FROM e_done d
LEFT JOIN (SELECT record_id, count(*) AS n FROM s_entities GROUP BY record_id) s ON d.record_id = s.record_id
LEFT JOIN (SELECT record_id, count(*) AS n FROM e_entities GROUP BY record_id) e ON d.record_id = e.record_id"""
    out["publish_notes"] = with_(*CHAIN, *ITEMS[1:], SIX, CTE_DX_ONLY) + """SELECT d.record_id, d.redacted AS redacted_text, coalesce(e.p, '') AS placeholders,
  coalesce(p.n, 0) AS n_matches, x.standard AS diagnosis, x.method, round((SELECT after FROM six WHERE dimension = 'Accuracy')::DOUBLE, 6) AS accuracy
FROM e_done d
LEFT JOIN (SELECT record_id, string_agg(placeholder, '|' ORDER BY part, seq) AS p FROM (
  SELECT record_id, 0 AS part, seq, placeholder FROM s_entities UNION ALL SELECT record_id, 1, seq, placeholder FROM e_entities) GROUP BY record_id) e ON d.record_id = e.record_id
LEFT JOIN (SELECT record_id, count(*) AS n FROM patterns GROUP BY record_id) p ON d.record_id = p.record_id
LEFT JOIN x ON d.record_id = x.record_id"""
    named = f"named AS ({inputs.NAMED_NOTES})"
    out["tag_gazetteer"] = with_(named, """parts AS (SELECT record_id, unnest([
  {'text': 'Hale', 'label': 'PERSON', 's': 3}, {'text': c_name, 'label': 'ORG', 's': 12}, {'text': clinic, 'label': 'ORG', 's': 16 + len(c_name)},
  {'text': 'Clinic', 'label': 'GPE', 's': 39 + len(c_name) + len(clinic)},
  {'text': p_name, 'label': 'LOC', 's': 53 + len(c_name) + len(clinic) + len(p_name)},
  {'text': vet, 'label': 'ORG', 's': 58 + len(c_name) + len(clinic) + 2 * len(p_name)}]) AS x FROM named)""") + (
        """SELECT record_id, x.text AS text, x.label AS label, x.s::BIGINT AS start, (x.s + len(x.text))::BIGINT AS "end" FROM parts"""
    )
    out["deidentify_gazetteer"] = with_(named) + """SELECT record_id, 'Dr [PERSON_1] saw ' || c_name || ' at ' || clinic || ', not [LOCATION_1] nor [LOCATION_1] and '
  || CASE record_id % 2 WHEN 0 THEN 'é' ELSE 'e' END || p_name || '. [LOCATION_2] via ' || vet || ', not x' || vet AS redacted_text, 3::BIGINT AS n_entities FROM named"""
    out["entities_all"] = with_(*CHAIN) + f"""SELECT {entity}, 'raw' AS frame FROM s_entities UNION ALL
SELECT record_id, seq + coalesce(n, 0), type, text, start::BIGINT, "end"::BIGINT, placeholder, 'regex_redacted'
FROM e_entities LEFT JOIN (SELECT record_id, count(*) AS n FROM s_entities GROUP BY record_id) USING (record_id)"""

    keys = with_(*KEYS)
    out["quasi_keys"] = keys + "SELECT * FROM keyed"
    out["k_groups"] = keys + "SELECT * FROM grp"
    out["k_risky_groups"] = keys + "SELECT * FROM grp WHERE n_records < 5"
    out["k_members"] = keys + "SELECT k.*, g.n_records, g.n_records < 5 AS risky FROM keyed k JOIN grp g ON k.age = g.age AND k.weight = g.weight AND k.sex = g.sex"
    out["k_summary"] = keys + summary("grp")
    out["generalise_age"] = keys + f"SELECT age, {AGE_BAND} AS age_band, count(*) AS n FROM keyed GROUP BY age"
    out["generalise_weight"] = keys + f"SELECT weight, {WEIGHT_BAND} AS weight_band, count(*) AS n FROM keyed GROUP BY weight"
    out["k_mitigated"] = with_(*KEYS, CTE_MITIGATED) + f"""SELECT n.record_id,
  CASE WHEN m.n_records < 5 THEN CASE WHEN m.age = 'unknown' THEN '' ELSE m.age END ELSE array_to_string({all_of('age')}, '|') END AS age_values,
  CASE WHEN m.n_records < 5 THEN CASE WHEN m.weight = 'unknown' THEN '' ELSE m.weight END ELSE array_to_string({all_of('weight')}, '|') END AS weight_values,
  m.sex, m.n_records, m.n_records < 5 AS risky FROM notes n JOIN mit m ON n.record_id = m.record_id"""
    out["k_before_after"] = with_(*KEYS, CTE_MITIGATED, "grp2 AS (SELECT age, weight, sex, count(*) AS n_records FROM mit GROUP BY age, weight, sex)") + (
        summary("grp", "before") + "\nUNION ALL\n" + summary("grp2", "after")
    )
    out["k_customers"] = with_(
        "keyed AS (SELECT n_name AS nation, c_mktsegment AS segment, CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey)",
        "grp AS (SELECT nation, segment, balance, count(*) AS n_records FROM keyed GROUP BY ALL)",
        """grp2 AS (SELECT nation, segment, CASE WHEN n_records >= 5 THEN balance WHEN balance LIKE '-%' THEN 'negative' ELSE 'positive' END AS balance2,
  sum(n_records) AS n_records FROM grp GROUP BY nation, segment, balance2)""",
    ) + summary("grp", "before") + "\nUNION ALL\n" + summary("grp2", "after")

    out["deid_eval_counts"] = with_(*EVAL) + "SELECT record_id, tp, fn, fp FROM ev"
    out["deid_eval_scores"] = with_(*EVAL) + """SELECT tp, fn, fp, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS r
  FROM (SELECT sum(tp)::BIGINT AS tp, sum(fn)::BIGINT AS fn, sum(fp)::BIGINT AS fp FROM ev))"""

    out["quality_completeness"] = notes + rounded_scores(Q_COMPLETE)
    out["quality_accuracy_raw"] = notes + f"""SELECT 'canonical' AS terms, round({raw_accuracy(RAW_CANONICAL)}, 6) AS before
UNION ALL SELECT 'abbreviations', round({raw_accuracy(['BAR', 'NAD', 'CRT', 'BP'])}, 6)"""
    out["quality_accuracy"] = with_(*ITEMS) + f"SELECT 'Accuracy' AS dimension, round({ACCURATE}, 6) AS after FROM items"
    out["quality_consistency"] = with_(*STD) + f"SELECT 'Consistency' AS dimension, 0.5::DOUBLE AS before, round({IN_RANGE}, 6) AS after FROM std"
    out["quality_validity"] = with_(*STD) + rounded_scores(validity("std"))
    out["quality_uniqueness"] = notes + rounded_scores(unique("notes", "raw_text"))
    out["quality_uniqueness_documents"] = rounded_scores(unique("documents", "text"))
    out["quality_standardisation"] = with_(*ITEMS) + f"SELECT 'Standardisation' AS dimension, 0.0::DOUBLE AS before, round({STANDARD}, 6) AS after FROM items"
    out["quality_uniqueness_sketches"] = """SELECT count(*) AS n, (count(DISTINCT text) + max((text IS NULL)::INT))::BIGINT AS distinct_texts, true AS near FROM documents"""
    out["quality_no_notes"] = """SELECT d AS dimension, b::DOUBLE AS before, b::DOUBLE AS after, 0::DOUBLE AS delta FROM (VALUES ('Completeness', 0), ('Accuracy', 0),
  ('Consistency', 0.5), ('Validity', 0), ('Uniqueness', 0), ('Standardisation', 0), ('OVERALL', 0.083333)) AS t(d, b)"""
    out["quality_report"] = with_(*ITEMS, SIX) + """SELECT dimension, round(before::DOUBLE, 6) AS before, round(after::DOUBLE, 6) AS after, round((after - before)::DOUBLE, 6) AS delta FROM (
  SELECT * FROM six UNION ALL SELECT 'OVERALL', avg(before), avg(after) FROM six)"""
    sides = ", ".join(
        f"(SELECT round({side}::DOUBLE, 6) FROM six WHERE dimension = '{d}') AS {d.lower()}_{side}"
        for d in ("Completeness", "Accuracy", "Consistency", "Validity", "Uniqueness", "Standardisation")
        for side in ("before", "after")
    )
    out["attach_scores"] = with_(*ITEMS, SIX) + f"SELECT record_id, {sides} FROM notes"
    return out
