"""Keys that similar texts share, as Spark SQL expression text.

Two texts of lengths L and M whose ratio is ``cutoff`` or more are at most ``k = (L + M) * (100 - cutoff) / 100`` insertions and
deletions apart.  Cut one of them into k + 1 pieces.  Going through the pieces, the number of changes so far less the
number of pieces so far begins at 0 and ends below it, one step down at a time; where it first does, a piece is unchanged and
has exactly as many changes before it as it has pieces before it.  So piece i stands in the other text, moved by -i, -i + 2,
..., or i places, and what is left of the k changes must make up for the rest of the difference in length.

One text of a pair writes its pieces (``piece_keys``), the other the places where they can stand (``probe_keys``); a pair that can
reach the cutoff has a key in common.  Keys are hashes: a collision gives a pair too many, never one too few.
"""

from __future__ import annotations

from noteloom.functions.text import let, lit

NO_KEYS = "cast(array() AS array<bigint>)"
# Two numbers of characters and the room they leave, so that both sides decide alike
LEAST = 1e-9


def _room(cutoff: float) -> float:
    return (100.0 - cutoff) / 100.0


def _changes(a: str, b: str, cutoff: float) -> str:
    """Most insertions and deletions between texts of these lengths; as odd or even as their difference is."""
    most = f"cast(floor(({a} + {b}) * {lit(_room(cutoff))} + {LEAST}D) AS int)"
    return let("ch_k", most, f"ch_k - abs(ch_k - abs({a} - {b})) % 2")


def lengths(length: str, cutoff: float) -> str:
    """Lengths of texts that can reach the cutoff with a text of this length; a cutoff above 0 keeps them few."""
    room = _room(cutoff)
    low, high = f"cast(floor({length} * {lit((1 - room) / (1 + room))}) AS int)", f"cast(ceil({length} * {lit((1 + room) / (1 - room))}) AS int)"
    # a change more or less is enough for both ends: those outside have no room for their difference
    return f"""filter(sequence(greatest({low}, 1), {high} + 1),
      ln_m -> abs({length} - ln_m) <= floor(({length} + ln_m) * {lit(room)} + {LEAST}D))"""


def _bound(i: str, length: str, pieces: str) -> str:
    return f"cast(floor({i} * {length} / {pieces}) AS int)"


def piece_keys(text: str, cutoff: float, tag: str) -> str:
    """``array<bigint>``: the pieces of ``text`` for every length that a text like it can have."""
    start, stop = _bound("pk_i", "pk_n", "(pk_k + 1)"), _bound("(pk_i + 1)", "pk_n", "(pk_k + 1)")
    piece = f"substring(pk_t, {start} + 1, {stop} - {start})"
    keys = f"transform(sequence(0, pk_k), pk_i -> xxhash64({lit(tag)}, pk_n, pk_m, pk_i, {piece}))"
    # more changes than characters: every text of such a length is met
    whole = f"array(xxhash64({lit(tag)}, pk_n, pk_m, -1, ''))"
    each = let("pk_k", _changes("pk_n", "pk_m", cutoff), f"if(pk_k < pk_n, {keys}, {whole})")
    body = f"flatten(transform({lengths('pk_n', cutoff)}, pk_m -> {each}))"
    return let("pk_t", text, let("pk_n", "length(pk_t)", f"if(pk_n > 0, {body}, {NO_KEYS})"))


def probe_keys(text: str, cutoff: float, tag: str) -> str:
    """``array<bigint>``: what stands in ``text`` where a piece of a text like it can."""
    start, stop = _bound("qk_i", "qk_n", "(qk_k + 1)"), _bound("(qk_i + 1)", "qk_n", "(qk_k + 1)")
    moved = "greatest(-qk_i, (qk_l - qk_n) - (qk_k - qk_i))", "least(qk_i, (qk_l - qk_n) + (qk_k - qk_i))"
    # both ends are as odd or even as the piece's number, so steps of two stay so
    moves = f"if({moved[0]} > {moved[1]}, cast(array() AS array<int>), sequence({moved[0]}, {moved[1]}, 2))"
    inside = f"{start} + qk_d >= 0 AND {stop} + qk_d <= qk_l"
    place = f"xxhash64({lit(tag)}, qk_n, qk_l, qk_i, substring(qk_t, {start} + qk_d + 1, {stop} - {start}))"
    keys = f"flatten(transform(sequence(0, qk_k), qk_i -> transform(filter({moves}, qk_d -> {inside}), qk_d -> {place})))"
    whole = f"array(xxhash64({lit(tag)}, qk_n, qk_l, -1, ''))"
    each = let("qk_k", _changes("qk_n", "qk_l", cutoff), f"if(qk_k < qk_n, {keys}, {whole})")
    body = f"flatten(transform({lengths('qk_l', cutoff)}, qk_n -> {each}))"
    return let("qk_t", text, let("qk_l", "length(qk_t)", f"if(qk_l > 0, {body}, {NO_KEYS})"))


def _window_pieces(length: str, cutoff: float) -> str:
    """Pieces of a text that has to stand, with changes, in a stretch of another as long as itself or shorter."""
    return f"(cast(floor(2 * {length} * {lit(_room(cutoff))} + {LEAST}D) AS int) + 1)"


def window_piece_keys(text: str, cutoff: float, tag: str) -> str:
    """The pieces of ``text`` as the shorter text of a pair, one of which its best window must hold."""
    start, stop = _bound("wk_i", "wk_n", "wk_p"), _bound("(wk_i + 1)", "wk_n", "wk_p")
    keys = f"transform(sequence(0, wk_p - 1), wk_i -> xxhash64({lit(tag)}, substring(wk_t, {start} + 1, {stop} - {start})))"
    cut = let("wk_p", f"least({_window_pieces('wk_n', cutoff)}, wk_n + 1)", keys)
    return let("wk_t", text, let("wk_n", "length(wk_t)", f"if(wk_n > 0, {cut}, {NO_KEYS})"))


def window_probe_keys(text: str, cutoff: float, tag: str, spread: float) -> str:
    """Every stretch of ``text`` that is as long as a piece of a text at least ``spread`` times shorter."""
    size = f"cast(floor(vk_n / least({_window_pieces('vk_n', cutoff)}, vk_n + 1)) AS int)"
    shorter = f"sequence(1, greatest(cast(floor(vk_l / {lit(spread)}) AS int), 1))"
    sizes = f"array_distinct(flatten(transform({shorter}, vk_n -> array({size}, {size} + 1))))"
    places = f"""if(vk_s = 0, array(xxhash64({lit(tag)}, '')), if(vk_s > vk_l, {NO_KEYS},
      transform(sequence(1, vk_l - vk_s + 1), vk_i -> xxhash64({lit(tag)}, substring(vk_t, vk_i, vk_s)))))"""
    body = f"flatten(transform({sizes}, vk_s -> {places}))"
    return let("vk_t", text, let("vk_l", "length(vk_t)", f"if(vk_l > 0, {body}, {NO_KEYS})"))
