"""Row-local span arithmetic: where patterns match, how spans merge, how they are replaced.

A span is ``struct<start, neg_len, rank, stop>`` with code-point offsets (stop exclusive).
The field order makes the natural struct order the one merging needs: first start, then
the longest, then the pattern order.  Nothing here shuffles or leaves the JVM.
"""

from __future__ import annotations

from noteloom.functions.text import all_matches, gaps, let, lits

SPAN = "struct<start:int,neg_len:int,rank:int,stop:int>"
NO_SPANS = f"cast(array() AS array<{SPAN}>)"
ENTITY = "struct<text:string,type:string,start:int,end:int,placeholder:string>"
# Items that are folded at once: appending to a list copies it, so lists are kept short and joined.
BLOCK = 128


def span(start: str, stop: str, rank: str) -> str:
    return f"named_struct('start', {start}, 'neg_len', {start} - ({stop}), 'rank', {rank}, 'stop', {stop})"


def slice_text(text: str, start: str, stop: str) -> str:
    return f"substring({text}, {start} + 1, {stop} - {start})"


def folded(items: str, kind: str, step: str, value: str) -> str:
    """``array<kind>`` made by going through ``items`` once with a running number ``fo_a.pos``, 0 at first.

    For an item ``fo_s`` the number becomes ``step``, and ``value``, unless it is NULL, is added.  Blocks of items are folded one
    after the other, so the time is in proportion to the items however many there are.
    """
    none = f"cast(array() AS array<{kind}>)"
    added = f"if(({value}) IS NULL, fo_a.out, array_append(fo_a.out, {value}))"
    own = items if items.isidentifier() else "fo_i"
    block = f"""aggregate(fo_b, named_struct('pos', fo_o.pos, 'out', {none}), (fo_a, fo_s) -> named_struct('pos', {step}, 'out', {added}),
        fo_a -> named_struct('pos', fo_a.pos, 'parts', array_append(fo_o.parts, fo_a.out)))"""
    whole = f"""if(size({own}) = 0, {none}, aggregate(
      transform(sequence(0, cast((size({own}) - 1) div {BLOCK} AS int)), fo_n -> slice({own}, fo_n * {BLOCK} + 1, {BLOCK})),
      named_struct('pos', 0, 'parts', cast(array() AS array<array<{kind}>>)), (fo_o, fo_b) -> {block}, fo_o -> flatten(fo_o.parts)))"""
    return whole if own == items else let("fo_i", items, whole)


def running(sizes: str) -> str:
    """``array<int>``: what stands before each of ``sizes``, added up."""
    return folded(sizes, "int", "fo_a.pos + fo_s", "fo_a.pos")


def pattern_spans(text: str, pattern: str, rank: int, ignore_case: bool = False) -> str:
    """Spans of one pattern, from its matches and the lengths of the gaps between them."""
    start = "fo_a.pos + fo_s.gap"
    pieces = f"""zip_with(slice({gaps(text, pattern, ignore_case)}, 1, size(ps_m)), ps_m,
        (ps_g, ps_x) -> named_struct('gap', length(ps_g), 'len', length(ps_x)))"""
    located = folded(pieces, SPAN, f"{start} + fo_s.len", span(start, f"{start} + fo_s.len", str(rank)))
    return let("ps_m", all_matches(text, pattern, ignore_case), f"if(size(ps_m) = 0, {NO_SPANS}, {located})")


def merge_overlapping(spans: str) -> str:
    """Union of each cluster of overlapping spans, ranked as the cluster's first span."""
    # the furthest stop up to each span; a cluster begins where that is not over the next start, and ends at it
    furthest = folded("mo_o", "int", "greatest(fo_a.pos, fo_s.stop)", "greatest(fo_a.pos, fo_s.stop)")
    begins = "filter(sequence(0, size(mo_o) - 1), mo_i -> mo_i = 0 OR get(mo_o, mo_i).start >= get(mo_f, mo_i - 1))"
    stop = "get(mo_f, coalesce(get(mo_c, mo_k + 1), size(mo_o)) - 1)"
    merged = let("mo_c", begins, f"transform(mo_c, (mo_b, mo_k) -> {span('get(mo_o, mo_b).start', stop, 'get(mo_o, mo_b).rank')})")
    return let("mo_o", f"array_sort({spans})", f"if(size(mo_o) <= 1, mo_o, {let('mo_f', furthest, merged)})")


def drop_overlapping(spans: str) -> str:
    """Of overlapping spans the first (then longest, then lowest rank) stays."""
    free = "fo_s.start >= fo_a.pos"
    kept = folded("do_o", SPAN, f"if({free}, fo_s.stop, fo_a.pos)", f"if({free}, fo_s, NULL)")
    return let("do_o", f"array_sort({spans})", f"if(size(do_o) <= 1, do_o, {kept})")


def in_numbering_order(text: str, spans: str, types: list[str], by_rank: bool) -> str:
    """Spans with their text and type, in the order of first appearance used for numbering.

    ``by_rank`` numbers pattern by pattern; otherwise spans are numbered from left to right.
    """
    return f"""array_sort(transform({spans}, no_s -> named_struct(
      'turn', {'no_s.rank' if by_rank else '0'}, 'start', no_s.start, 'stop', no_s.stop, 'rank', no_s.rank,
      'type', get(array({lits(types)}), no_s.rank), 'text', {slice_text(text, 'no_s.start', 'no_s.stop')})))"""


def placeholders(ordered: str) -> str:
    """``array<struct<text, name>>``: one ``[TYPE_n]`` per distinct text, n counting within the type.

    A text found under two types keeps the type it had first.
    """
    by_type = f"""array_sort(transform(
      filter({ordered}, (ph_s, ph_i) -> array_position(ph_t, ph_s.text) = ph_i + 1),
      (ph_s, ph_i) -> named_struct('rank', ph_s.rank, 'seen', ph_i, 'type', ph_s.type, 'text', ph_s.text)))"""
    named = """transform(ph_v, (ph_x, ph_n) -> named_struct('text', ph_x.text,
      'name', concat('[', ph_x.type, '_', cast(ph_n + 2 - array_position(ph_r, ph_x.rank) AS string), ']')))"""
    return let("ph_t", f"{ordered}.text", let("ph_v", by_type, let("ph_r", "ph_v.rank", named)))


def with_placeholders(ordered: str) -> str:
    """Entities ``struct<text, type, start, end, placeholder>`` in numbering order."""
    labelled = f"""transform({ordered}, wp_s -> named_struct('text', wp_s.text, 'type', wp_s.type,
      'start', wp_s.start, 'end', wp_s.stop,
      'placeholder', get(wp_n, cast(array_position(wp_t, wp_s.text) - 1 AS int))))"""
    return let("wp_p", placeholders(ordered), let("wp_t", "wp_p.text", let("wp_n", "wp_p.name", labelled)))


def replace_spans(text: str, entities: str) -> str:
    """``text`` with each of the disjoint ``entities`` replaced by its placeholder."""
    by_position = f"""array_sort(transform({entities}, rs_e ->
      named_struct('start', rs_e.start, 'stop', rs_e.`end`, 'name', rs_e.placeholder)))"""
    before = slice_text(text, "coalesce(get(rs_p, rs_i - 1).stop, 0)", "rs_x.start")
    pieces = f"""concat(
      array_join(transform(rs_p, (rs_x, rs_i) -> concat({before}, rs_x.name)), ''),
      substring({text}, get(rs_p, size(rs_p) - 1).stop + 1, length({text})))"""
    return f"if(size({entities}) = 0, {text}, {let('rs_p', by_position, pieces)})"


def redaction(text: str, spans: str, types: list[str], by_rank: bool) -> str:
    """``struct<redacted_text, entities>`` for disjoint ``spans`` of ``text``."""
    replaced = f"named_struct('redacted_text', {replace_spans(text, 're_e')}, 'entities', re_e)"
    whole = let(
        "re_o", in_numbering_order(text, "re_s", types, by_rank), let("re_e", with_placeholders("re_o"), replaced)
    )
    # most texts have none, and need no list but the empty one
    none = f"named_struct('redacted_text', {text}, 'entities', cast(array() AS array<{ENTITY}>))"
    return let("re_s", spans, f"if(size(re_s) = 0, {none}, {whole})")
