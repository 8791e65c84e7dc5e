"""Plain versions of the operators, for tests on small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": failed,
    }


def line_verdicts(rows: list[tuple], sketches: list, share: float, floor: int, min_left: float) -> list[tuple[int, bool]]:
    """``(removed words, kept)`` of ``(doc_id, text, source)`` rows; equal sketches are one document."""
    where, hosts, own = defaultdict(set), defaultdict(set), []
    for (_, text, source), sketch in zip(rows, sketches, strict=True):
        lines = [" ".join(WORD.findall(x)).lower() for x in (text or "").split("\n") if WORD.search(x)]
        own.append((source or "", lines))
        hosts[source or ""].add(sketch)
        for line in lines:
            where[source or "", line].add(sketch)
    out = []
    for (host, lines), row in zip(own, rows, strict=True):
        gone = sum(len(x.split(" ")) for x in lines if len(where[host, x]) > max(floor, share * len(hosts[host])))
        base = base_rules(row[1])
        out.append((gone, not base["base_failed"] and base["n_words"] - gone >= min_left * base["n_words"]))
    return out
