"""String and vector similarity as Spark SQL expression text.

The ratio of two texts is ``200 * LCS / (len a + len b)``.  The longest common subsequence is
found with the bit-vector method of Crochemore et al. (2001) and Hyyro (2004): one 64-bit word
per candidate, folded over the characters of the other text.
"""

from __future__ import annotations

from noteloom.functions.patterns import SPACE
from noteloom.functions.text import let, lit

WORD_BITS = 62


def chars(text: str) -> str:
    """The characters of ``text``; the empty text has none."""
    return f"filter(split({text}, ''), ch_c -> ch_c <> '')"


def char_masks(text: str) -> str:
    """``map<char, bit set of its positions>`` for a text of at most WORD_BITS characters."""
    bits = """aggregate(transform(cm_s, (cm_x, cm_i) -> if(cm_x = cm_c, shiftleft(1L, cm_i), 0L)), 0L, (cm_a, cm_b) -> cm_a + cm_b)"""
    return let("cm_s", chars(text), f"map_from_entries(transform(array_distinct(cm_s), cm_c -> struct(cm_c, {bits})))")


def _lcs_bits(masks: str, b: str, other: str) -> str:
    step = let("lb_u", f"lb_v & coalesce(try_element_at({masks}, lb_c), 0L)", "((lb_v + lb_u) | (lb_v - lb_u)) & lb_f")
    fold = f"aggregate({chars(other)}, lb_f, (lb_v, lb_c) -> {step}, lb_v -> bit_count(~lb_v & lb_f))"
    return let("lb_f", f"shiftleft(1L, length({b})) - 1L", fold)


def _lcs_table(a: str, b: str) -> str:
    """The row-by-row method, for texts too long for one word."""
    cell = "if(get(lt_s, lt_j - 1) = lt_c, get(lt_p, lt_j - 1) + 1, greatest(get(lt_p, lt_j), get(lt_q, lt_j - 1)))"
    row = f"aggregate(sequence(1, size(lt_s)), array(0), (lt_q, lt_j) -> array_append(lt_q, {cell}))"
    last = f"aggregate({chars(a)}, array_repeat(0, size(lt_s) + 1), (lt_p, lt_c) -> {row}, lt_p -> get(lt_p, size(lt_s)))"
    return let("lt_s", chars(b), f"if(size(lt_s) = 0, 0, {last})")


def lcs_length(a: str, b: str, b_masks: str | None = None) -> str:
    """Length of the longest common subsequence; ``b_masks`` are its ready-made masks."""
    in_word = _lcs_bits(b_masks, b, a) if b_masks else let("ll_m", char_masks(b), _lcs_bits("ll_m", b, a))
    return f"if(length({b}) <= {WORD_BITS}, {in_word}, {_lcs_table(a, b)})"


def can_reach(a: str, b: str, cutoff: str, total: str | None = None) -> str:
    """Cheap necessary condition for a ratio of at least ``cutoff``.

    The number of insertions and deletions between two texts is at least their difference in
    length and at least their edit distance, which Spark computes natively.
    """
    allowed = f"({total or f'(length({a}) + length({b}))'} * (100 - {cutoff}) / 100 + 1e-9D)"
    return f"(abs(length({a}) - length({b})) <= {allowed} AND levenshtein({a}, {b}) <= {allowed})"


def ratio(a: str, b: str, cutoff: str = "0D", b_masks: str | None = None) -> str:
    """Similarity in percent; 0 if it is below ``cutoff``."""
    total = f"(length({a}) + length({b}))"
    score = let("ra_s", f"{lcs_length(a, b, b_masks)} * 200D / {total}", f"if(ra_s >= {cutoff} - 1e-9D, ra_s, 0D)")
    return f"CASE WHEN {total} = 0 THEN 100D WHEN {can_reach(a, b, cutoff)} THEN {score} ELSE 0D END"


def tokens(text: str) -> str:
    return f"filter(split({text}, {lit(SPACE + '+')}), to_t -> to_t <> '')"


def joined(parts: str) -> str:
    return f"array_join(array_sort({parts}), ' ')"


def pair(a: str, b: str, scale: float = 1.0) -> str:
    return f"named_struct('scale', {lit(float(scale))}, 'a', {a}, 'b', {b})"


def best_ratio(pairs: str, cutoff: float) -> str:
    """Highest scaled ratio of an array of pairs; what cannot reach ``cutoff`` counts as 0."""
    scaled = ratio("br_p.a", "br_p.b", f"({lit(float(cutoff))} / br_p.scale)")
    return f"array_max(transform({pairs}, br_p -> br_p.scale * ({scaled})))"


def token_sort_ratio(a: str, b: str, cutoff: float = 0.0) -> str:
    return best_ratio(f"array({pair(joined(tokens(a)), joined(tokens(b)))})", cutoff)


def token_set_ratio(a: str, b: str, cutoff: float = 0.0) -> str:
    """Ratio after setting the common words aside; 100 if one text has only words of the other."""
    la, lb, size = "length(ts_x)", "length(ts_y)", "length(ts_c)"
    whole = f"(2 * ({size} + if({size} > 0, 1, 0)) + {la} + {lb})"
    distance = f"({la} + {lb} - 2 * {lcs_length('ts_x', 'ts_y')})"
    # below the cutoff the value of this part does not matter
    apart = f"if({can_reach('ts_x', 'ts_y', lit(float(cutoff)), whole)}, 100D - 100D * {distance} / {whole}, 0D)"
    with_a = f"if({size} > 0, 100D - 100D * (1 + {la}) / (2 * {size} + 1 + {la}), 0D)"
    with_b = f"if({size} > 0, 100D - 100D * (1 + {lb}) / (2 * {size} + 1 + {lb}), 0D)"
    scored = let(
        "ts_c", joined("array_intersect(ts_a, ts_b)"),
        let("ts_x", joined("array_except(ts_a, ts_b)"),
            let("ts_y", joined("array_except(ts_b, ts_a)"), f"greatest({apart}, {with_a}, {with_b})")),
    )
    covered = "arrays_overlap(ts_a, ts_b) AND (size(array_except(ts_a, ts_b)) = 0 OR size(array_except(ts_b, ts_a)) = 0)"
    cases = f"CASE WHEN size(ts_a) = 0 OR size(ts_b) = 0 THEN 0D WHEN {covered} THEN 100D ELSE {scored} END"
    return let("ts_a", tokens(a), let("ts_b", tokens(b), cases))


def best_window(pairs: str, cutoff: float) -> str:
    """Highest scaled ratio of the shorter text of a pair with a piece of the longer one.

    Pieces are all substrings as long as the shorter text, and the shorter ones at both ends.
    Texts of equal length are tried both ways.
    """
    there = "named_struct('scale', bw_p.scale, 'short', bw_p.a, 'long', bw_p.b)"
    back = "named_struct('scale', bw_p.scale, 'short', bw_p.b, 'long', bw_p.a)"
    ways = f"""transform({pairs}, bw_p -> CASE WHEN length(bw_p.a) < length(bw_p.b) THEN array({there})
      WHEN length(bw_p.b) < length(bw_p.a) THEN array({back}) ELSE array({there}, {back}) END)"""
    piece = """substring(bw_w.long, greatest(bw_i, 1),
      least(bw_i + length(bw_w.short), length(bw_w.long) + 1) - greatest(bw_i, 1))"""
    scaled = ratio("bw_x", "bw_w.short", f"({lit(float(cutoff))} / bw_w.scale)", "bw_m")
    best = f"""array_max(transform(
      transform(sequence(2 - length(bw_w.short), length(bw_w.long)), bw_i -> {piece}), bw_x -> {scaled}))"""
    masks = f"if(length(bw_w.short) <= {WORD_BITS}, {char_masks('bw_w.short')}, NULL)"
    score = f"if(length(bw_w.short) = 0, if(length(bw_w.long) = 0, 100D, 0D), {let('bw_m', masks, best)})"
    return f"array_max(transform(flatten({ways}), bw_w -> bw_w.scale * {score}))"


def partial_ratio(a: str, b: str, cutoff: float = 0.0) -> str:
    """Best ratio of the shorter text with a piece of the longer one."""
    return best_window(f"array({pair(a, b)})", cutoff)


def _word_pairs(a: str, b: str, scale: float) -> str:
    """Pairs of the sorted words of two token lists, with and without repeated ones."""
    once = pair(joined(f"array_distinct({a})"), joined(f"array_distinct({b})"), scale)
    return f"array_distinct(array({pair(joined(a), joined(b), scale)}, {once}))"


def partial_token_ratio(a: str, b: str, cutoff: float = 0.0) -> str:
    """100 if a word is shared, else the best partial ratio of the sorted words."""
    scored = f"if(arrays_overlap(pt_a, pt_b), 100D, {best_window(_word_pairs('pt_a', 'pt_b', 1.0), cutoff)})"
    return let("pt_a", tokens(a), let("pt_b", tokens(b), scored))


def weighted_ratio(a: str, b: str, cutoff: float = 0.0) -> str:
    """The best of the plain, word-based and (for unequal lengths) partial ratios, each weighted.

    Alike comparisons go through one array each, which keeps the expression small.
    """
    la, lb, limit = f"length({a})", f"length({b})", lit(float(cutoff))
    spread = f"(greatest({la}, {lb}) / least({la}, {lb}))"
    sorted_words = pair(joined("wr_a"), joined("wr_b"), 0.95)
    close = f"""greatest({best_ratio(f'array({pair(a, b)}, {sorted_words})', cutoff)},
      0.95D * {token_set_ratio(a, b, cutoff / 0.95)})"""
    shared = "arrays_overlap(wr_a, wr_b)"

    def apart(scale: float) -> str:
        whole = f"array({pair(a, b, scale)})"
        pairs = f"if({shared}, {whole}, concat({whole}, {_word_pairs('wr_a', 'wr_b', 0.95 * scale)}))"
        return f"greatest({ratio(a, b, limit)}, {best_window(pairs, cutoff)}, if({shared}, {lit(95.0 * scale)}, 0D))"

    # a scale of 0.6 cannot lift anything over a higher cutoff
    far = apart(0.6) if cutoff <= 60 else ratio(a, b, limit)
    best = f"CASE WHEN {spread} < 1.5 THEN {close} WHEN {spread} <= 8 THEN {apart(0.9)} ELSE {far} END"
    scored = let("wr_a", tokens(a), let("wr_b", tokens(b), best))
    return f"if({la} = 0 OR {lb} = 0, 0D, {scored})"


def dot(a: str, b: str) -> str:
    products = f"zip_with({a}, {b}, (dt_x, dt_y) -> cast(dt_x AS double) * cast(dt_y AS double))"
    return f"aggregate({products}, 0D, (dt_s, dt_p) -> dt_s + dt_p)"


def norm(vector: str) -> str:
    return f"sqrt({dot(vector, vector)})"


def hashed_ngrams(text: str, n: int = 3, dims: int = 64) -> str:
    """Counts of the character n-grams of the lower-cased, padded text, hashed to ``dims`` buckets.

    A model-free vector for text; replace it by any expression that gives ``array<float>``.
    """
    code = "0L"
    for k in range(n):
        code = f"({code} * 31 + get(hn_c, hn_i + {k}))"
    buckets = f"""if(size(hn_c) < {n}, cast(array() AS array<int>),
      transform(sequence(0, size(hn_c) - {n}), hn_i -> cast(pmod({code}, {dims}) AS int)))"""
    counts = f"transform(sequence(0, {dims - 1}), hn_d -> cast(size(hn_b) - size(array_remove(hn_b, hn_d)) AS float))"
    codes = f"transform({chars(f'concat(" ", lower({text}), " ")')}, hn_x -> ascii(hn_x))"
    return let("hn_c", codes, let("hn_b", buckets, counts))
