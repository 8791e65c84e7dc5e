"""Alignment, secrets and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log2

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from noteloom.llm import alignment, periodic, queries, scratch, secrets

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id bigint, text string, row string, spans string, runs string, a string, longest string, n_a string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPECIAL = [
    None, "", " ", "  ", "\n", " \n\t ", "one", "one ", " one", "  one  two   three ", "naïve café 😀 日本語 テスト", "a\x00b", "▁under", "x▁ y",
    "<|endoftext|> it's <s>x</s> <0x41> <unk>", " non breaking   em　", "I'm we'll", "é ﬁx İ ß", "日本語" * 400, "x" * 3000,
    "word " * 1500, "end of line\n\n  next\r\n\tline ", "﻿mark   sep \u0085 nel",
]


@pytest.fixture(scope="module")
def ship(spark):
    scratch.ship(spark)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(21)
    letters = list("ab Z'1é\n\t  ,.!²İ́ \x1c　中s|<> \u0085▁")
    made = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(400)]
    return SPECIAL + made + made[:5]


@pytest.fixture(scope="module")
def docs(spark, ship, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(3, "under three again"), (None, "no id"), (None, None)]
    return spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], DOCS).repartition(3)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with a ``documents`` table of these rows."""

    def make(frame):
        path = str(tmp_path / f"tables{random.random()}")
        frame.write.parquet(f"{path}/documents.parquet")
        return path

    return make


# --- alignment -------------------------------------------------------------------------------


def plain_alignment(texts):
    """Tokens, groups and links of each text by comparing the byte ranges of all tokens."""
    lib, model = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    lib.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        spelt_a = [bytes(back[x] for x in lib.id_to_token(i)) for i in a]
        spelt_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
        if not text or b"".join(spelt_a) != whole or b"".join(spelt_b) != whole:
            out.append(([], [], "", []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (spelt_a, spelt_b))
        groups, at_a, at_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        links, low = [], 0
        for i, (s, e) in enumerate(zip(starts_a, ends_a, strict=True)):
            while ends_b[low] <= s:
                low += 1
            j = low
            while j < len(b) and starts_b[j] < e:
                links.append((a[i], b[j]))
                j += 1
        out.append((a, b, ";".join(groups), links))
    return out


def test_path_cuts_into_equal_pieces():
    rng = np.random.default_rng(3)
    for _ in range(60):
        top = int(rng.integers(2, 300))
        a, b = (np.append(np.flatnonzero(rng.random(top) < p), top) for p in rng.random(2))
        whole = alignment.merged(a, b, 1 << 20)
        for steps in (1, 2, 7, 64):
            in_a, in_b = alignment.cut_path(a, b, steps)
            assert (np.diff(in_a + in_b)[:-1] == steps).all() and in_a[-1] == len(a) and in_b[-1] == len(b)
            cut = alignment.merged(a, b, steps)
            assert sorted(zip(*cut[:2], strict=True)) == sorted(zip(*whole[:2], strict=True))
            assert [x.tolist() for x in cut[2:]] == [x.tolist() for x in whole[2:]]
        # a stretch of bytes between two ends lies in the first token of each side that does not end before it
        ends = sorted({*a.tolist(), *b.tolist()})
        assert sorted(zip(*whole[:2], strict=True)) == sorted((int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends)
        assert a[whole.close_a].tolist() == b[whole.close_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


@pytest.mark.parametrize("steps", [5, 1 << 14])
def test_alignment_equals_plain(docs, steps):
    source = docs.collect()
    plain = plain_alignment([r.text for r in source])
    got = alignment.aligned(docs, BYTES, PIECES, steps=steps).collect()
    flat = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, tuple(zip(r.a, r.b, r.times, strict=True))) for r in got)
    expected = Counter()
    for row, (a, b, groups, links) in zip(source, plain, strict=True):
        pairs = tuple((*p, n) for p, n in sorted(Counter(links).items()))
        expected[row.doc_id, len(a), len(b), groups.count(";") + bool(groups), len(links), groups, pairs] += 1
    assert flat == expected
    assert sum(n for key, n in flat.items() if key[1]) > 150
    assert len({r.row for r in got}) == len(got)


def plain_scores(plain):
    count = Counter(p for _, _, _, links in plain for p in links)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [(sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links)) for _, _, _, links in plain]


def test_alignment_query(spark, docs, tables):
    source = docs.collect()
    plain = plain_alignment([r.text for r in source])
    expected = Counter()
    for row, (a, b, groups, links), scores in zip(source, plain, plain_scores(plain), strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        expected[row.doc_id, len(a), len(b), groups.count(";") + bool(groups), len(links), *scores, digest] += 1
    got = queries.registered()["op11_alignment"](spark, tables(docs))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert Counter(map(tuple, got.collect())) == expected
    # with hardly any pair sent to all tasks
    rows = scratch.written(alignment.aligned(docs, BYTES, PIECES, digest=True), "test-aligned")
    few = alignment.scored(rows, alignment.pair_counts(rows), hot_pairs=20)
    assert Counter((r.doc_id, r.n_best, r.count_sum) for r in few.collect()) == Counter((k[0], *k[5:7]) for k in expected.elements())
    assert queries.registered()["op11_alignment"](spark, tables(docs.limit(0))).count() == 0


# --- secrets ---------------------------------------------------------------------------------


def plain_base(text):
    found = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(secrets.BASE_KINDS[k], s, e) for s, k, e in sorted(found)]


def plain_windows(letters, width, bits, needs):
    """The entropy of every window from scratch."""
    good = []
    for i in range(len(letters) - width + 1):
        window = letters[i : i + width]
        entropy = -sum(n / width * log2(n / width) for n in Counter(window).values())
        if entropy >= bits - 1e-9 and all(set(window) & set(k) for k in needs):
            good.append((i, i + width))
    out = []
    for s, e in good:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


KEYS = [
    "wJalrXUtnFEMIK7MDENGbPxRfiCYzQp4Kd8Lm2Vt", "Zx9Qp2Lm7Rt4Vb8Nc1Kd6Hs3", "9f8a7B6c5D4e3F2a1B0c9D8e7F6a5B4c", "k3j9x2m7q1w8z5v4n6b0t2r8p3",
]
CLEAN = [
    "see https://host.org/a1B2c3D4e5F6g7H8i9J0k1L2m3 for more", "id 123e4567-E89b-12d3-A456-426614174000 of the row", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdef", "einheitaustkeitchenzuberst and internationalisationally", "EXAMPLEkey9Qp2Lm7Rt4Vb8Nc1Kd6Hs3Zx", "a" * 400 + "1B" * 300,
]


def secret_texts():
    rng = random.Random(5)
    letters = list("0123456789abcdefghijABCDEF+/=_-") + ["password", "Token: ", "apiKey='", "secret=", "AKIA", " ", "ſecret=abcdefg", "toKen=abcdefg", "é", "\n"]
    return ["".join(rng.choices(letters, k=rng.randint(1, 90))) for _ in range(300)] + [f"é {k} x" for k in KEYS] + CLEAN


def test_windows_equal_plain():
    rng = random.Random(6)
    for _ in range(200):
        letters = "".join(rng.choices("abcdefgh0123", weights=[rng.random() for _ in range(12)], k=rng.randint(0, 80)))
        for width, bits in ((8, 2.0), (24, 2.8), (10, 3.0)):
            assert secrets.even_windows(letters, width, bits, ("0123", "abcdefgh")) == plain_windows(letters, width, bits, ("0123", "abcdefgh"))


def test_secret_spans(spark, ship, tables):
    texts = [None, "", "password = hunter2", "password: abc", *secret_texts(), "token=" + "x1" * 60000, "secret='a.b-c_d'"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "password = hunter2"), (None, "token: abcdef")]
    docs = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], DOCS)
    got = secrets.secret_spans(docs).collect()
    spans = [(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got]
    base = Counter((i, tuple(s for s in own if s[0] in secrets.BASE_KINDS)) for i, own in spans)
    assert base == Counter((i, tuple(plain_base(t or ""))) for i, t in rows)
    added = {i: [s for s in own if s[0] not in secrets.BASE_KINDS] for i, own in spans}
    where = {t: i for i, t in rows}
    for key in KEYS:
        text = f"é {key} x"
        assert any(s[1] <= 4 and s[2] >= len(text) - 6 for s in added[where[text]]), key
    assert all(not added[where[t]] for t in CLEAN)
    for i, own in spans:
        assert list(own) == sorted(own, key=lambda s: (s[1], [*secrets.BASE_KINDS, *(c.kind for c in secrets.CLASSES)].index(s[0])))
        for kind, s, e in added[i]:
            (c,) = [c for c in secrets.CLASSES if c.kind == kind]
            assert e - s >= c.width and not set(texts[i][s:e]) - set(c.letters)
            assert not any(b[1] <= s and e <= b[2] for b in own if b != (kind, s, e))
    assert any(added.values())
    out = queries.registered()["op12_secrets"](spark, tables(docs)).collect()
    joined = lambda own: ",".join(f"{k}:{s}:{e}" for k, s, e in own)
    expected = Counter()
    for i, own in spans:
        mine = [s for s in own if s[0] in secrets.BASE_KINDS]
        kinds = Counter(s[0] for s in mine)
        expected[i, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(mine).encode()).hexdigest(), joined(own)] += 1
    assert Counter(map(tuple, out)) == expected
    assert secrets.secret_spans(docs.limit(0)).count() == 0


# --- periodic runs ---------------------------------------------------------------------------


def plain_runs(words, shortest=6, repeats=4):
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(shortest, repeats * q) and (start, length) not in found:
                found[start, length] = q  # a smaller lag came first
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def word_lists():
    rng = random.Random(8)
    yield from ([], ["a"], ["a"] * 6, ["a"] * 5, ["a", "b"] * 4, ["a"] * 2000, ["a", "b", "a"] * 300, (["a"] * 30 + ["b"]) * 40)
    for _ in range(1500):
        words = rng.choices("abc"[: rng.randint(1, 3)], k=rng.randint(0, 70))
        for _ in range(rng.randint(0, 3)):
            at, own = rng.randint(0, len(words)), rng.choices("abcd", k=rng.randint(1, 9))
            words[at:at] = (own * rng.randint(2, 7))[: rng.randint(1, 60)]
        yield words
    # nested runs: periods of periods
    for _ in range(100):
        inner = rng.choices("ab", k=rng.randint(1, 3)) * rng.randint(3, 6) + rng.choices("abc", k=rng.randint(0, 2))
        yield rng.choices("abc", k=rng.randint(0, 5)) + inner * rng.randint(3, 6) + rng.choices("abc", k=rng.randint(0, 5))


def test_runs_equal_plain(monkeypatch):
    for many in (periodic.MANY, 0):  # with the earlier occurrences, and with divisors wherever there is one
        monkeypatch.setattr(periodic, "MANY", many or 1)
        for words in word_lists():
            assert periodic.runs_of(words) == plain_runs(words), words
            assert periodic.runs_of(words, 3, 3) == plain_runs(words, 3, 3), words
    with pytest.raises(ValueError, match="three"):
        periodic.runs_of(["a"], repeats=2)


def test_long_texts_of_one_word_are_quick():
    rng = random.Random(9)
    assert periodic.runs_of(["a"] * 400_000) == [(0, 400_000, 1)]
    words = rng.choices(["a", "b", "c"], weights=[50, 1, 1], k=100_000)
    assert all(length >= max(6, 4 * q) for _, length, q in periodic.runs_of(words))


def echoed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) & 0xFFFFFFFF
    if doc_id is None or h % 10 or not words:
        return list(words)
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_periodic_query(spark, ship, tables):
    rng = random.Random(10)
    texts = [None, "", " \n ", "a " * 7, "x y\x0bx\x0cy\tx\r\ny x y x y"]
    texts += [rng.choice(["  ", "\n", " "]).join(rng.choices(["é", "b", "c d", " e", "f"], k=rng.randint(0, 200))) for _ in range(300)]
    texts += ["start " + "again and again " * 2000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, "z " * 9), (None, None)]
    docs = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], DOCS).repartition(3)
    expected = Counter()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc_id, text in rows:
        words = echoed(doc_id, WORD.findall(text or ""))
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected[doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(left)] += 1
    got = queries.registered()["op13_periodic"](spark, tables(docs))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert Counter(map(tuple, got.collect())) == expected
    assert sum(key[1] > 0 for key in expected) > 30
    assert queries.registered()["op13_periodic"](spark, tables(docs.limit(0))).count() == 0
