"""Each operator against a plain version, on small tables with odd rows."""

from __future__ import annotations

import gc
import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import brute
import compare
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from noteloom.llm import components, line_rules, packing, preference, queries, scratch, sharding, simhash, token_index, topk, toxicity, transducer, warc, words
from noteloom.llm.words import WordEncoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, fp string, row string, slot string, ids string"
ODD = [
    None, "", " \n\t ", "one", "One two", "one TWO three", "one two three four", "A b c d e f g h i j", "x" * 5000,
    "word " * 3000, "line one here\nline one here\n\nother line\n line one here ", "# * $ % & | < > #", "naïve café 😀 日本語",
    "a  b   c\n\n d\t", "<|endoftext|> it's <|startoftext|>", " non breaking   em", "I'm we'll THEY'RE 's",
]


@pytest.fixture(scope="module")
def ship(spark):
    scratch.ship(spark)


@pytest.fixture(scope="module")
def docs(spark, ship):
    rows = [(i, t, "en", f"s{i % 2}" if i % 5 else None, 1) for i, t in enumerate(ODD)]
    rows += [(7, ODD[7], "en", "s1", 1), (7, "another text under seven", "en", "s1", 1), (None, "no id here", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], DOCS)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows_of(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


# --- near duplicates -------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_fingerprint():
    texts = [*ODD, "the quick brown fox jumps over the lazy dog " * 40]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_golay_decodes_every_word_within_three_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    low, high, errors = simhash._golay()
    assert len(set(errors.tolist())) == 2048
    syndromes = low[words & 0xFFF] ^ high[words >> 12]
    code = words ^ errors[syndromes]
    assert (np.bitwise_count(code ^ words) <= 3).all()
    assert not (low[code & 0xFFF] ^ high[code >> 12]).any()


def test_close_fingerprints_share_a_key():
    rng = random.Random(3)
    for _ in range(400):
        one = rng.getrandbits(64)
        other = one
        for b in rng.sample(range(64), rng.randint(0, 4)):
            other ^= 1 << b
        rows, keys = simhash.fuzzy_keys(np.array([one, other], np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def groups_of(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if bin(a ^ b).count("1") <= 4:
            root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_groups_are_those_of_all_pairs(spark, ship):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for seed in list(fps):
        walk = seed
        for _ in range(12):  # chains that leave the four bits of their first member
            for b in rng.sample(range(64), rng.randint(1, 5)):
                walk ^= 1 << b
            fps.add(walk)
    signed = [(int(np.array(f, np.uint64).view(np.int64)),) for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp bigint"))
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in links.collect())
    found = {r.node & (1 << 64) - 1: r.root for r in components.components(links).collect()}
    truth = groups_of(sorted(fps))
    many = {f for f in fps if sum(truth[f] == truth[g] for g in fps) > 1}
    assert set(found) == many
    assert len({(truth[f], found[f]) for f in many}) == len({truth[f] for f in many}) == len(set(found.values()))


def test_near_duplicates_of_odd_rows(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_text = Counter(r.fingerprint for r in got)
    assert by_text["0" * 16] >= 3
    source = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    truth = groups_of(sorted({f for _, f in source}))
    least = {}
    for i, f in source:
        if i is not None:
            least[truth[f]] = min(i, least.get(truth[f], i))
    expected = sorted(((i, format(f, "016x"), least.get(truth[f])) for i, f in source), key=key)
    assert sorted(rows_of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id"), key=key) == expected
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    # a row of each group, also where an id names more than one
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i in least.values())
    assert len({truth[plain_fingerprint(r.text)] for r in kept.collect()}) == kept.count() == len(set(truth.values()))


def test_deduplicate_without_names_and_with_repeated_ones(spark, ship):
    texts = [" ".join(f"{w}{k}" for w in range(30)) for k in range(4)]
    rows = [(None, texts[0], "a"), (None, texts[0], "b"), (None, texts[1], "c"), (3, texts[1], "d"), (3, texts[2], "e"), (2, texts[2], "f"), (None, None, "g"), (None, "", "h")]
    assert len({*groups_of({plain_fingerprint(t) for _, t, _ in rows}).values()}) == 4
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string, extra string")).collect()
    assert sorted(((r.doc_id, r.text or "") for r in got), key=key) == [(None, ""), (None, texts[0]), (2, texts[2]), (3, texts[1])]


def test_no_text_is_lost_to_a_repeated_id(spark, ship):
    texts = [" ".join(f"{w}{k}" for w in range(30)) for k in range(3)]
    rows = [(4, texts[0], "a", "x", 1, "k"), (4, texts[1], "b", "y", 2, "l"), (4, texts[0], "c", "z", 3, "m"), (9, texts[2], "d", "w", 4, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _hash string, _kept string, kept_id bigint, OWN_HASH string")
    got = simhash.deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted([(4, texts[0]), (4, texts[1]), (9, texts[2])])


def test_components_of_a_long_path_and_of_nothing(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 3), (200, 201), (201, 200)], "a bigint, b bigint")
    found = dict(rows_of(components.components(path), "node", "root"))
    assert found == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200}
    assert components.components(path.limit(0)).count() == 0


# --- shards ----------------------------------------------------------------------------------


def test_shards(docs, empty):
    got = sharding.shard_records(docs, shards=3, slots=64).collect()
    source = sorted(((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=key)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=key) == source
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})
    assert sharding.shard_records(empty).count() == 0


def test_a_crowded_slot_is_divided(spark, ship):
    rows = [(i, "t" * 40) for i in range(3000)] + [(None, "t" * 40)] * 2000 + [(77, "t" * 40)] * 1000
    got = sharding.shard_records(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    sums, places = Counter(), {}
    for r in got:
        sums[r.shard] += r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    mean = sum(sums.values()) / 24
    assert len(got) == 6000 and len(sums) == 24 and all(abs(x - mean) <= 0.05 * mean for x in sums.values())
    assert all(sorted(x) == list(range(len(x))) for x in places.values())


def test_rebalancing_evens_bytes_and_moves_little():
    rng = random.Random(2)
    loads = {s: int(rng.paretovariate(1.5) * 100) for s in range(4096)}
    first = sharding.even(4096, 24)
    after = sharding.rebalanced(first, loads, 24)
    sums = Counter()
    for slot, shard in enumerate(after):
        sums[shard] += loads[slot]
    assert max(sums.values()) <= 1.01 * sum(loads.values()) / 24 + max(loads.values())
    assert sum(a != b for a, b in zip(first, after, strict=True)) < 2000
    assert sharding.rebalanced(after, {}, 24) == after


# --- quality ---------------------------------------------------------------------------------


def test_rules_of_odd_rows(docs, empty):
    rows = docs.select("doc_id", "text", "source").collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter(rows_of(line_rules.quality(docs), "doc_id", *names))
    assert got == Counter((r.doc_id, *(brute.base_rules(r.text)[n] for n in names)) for r in rows)
    assert line_rules.quality(empty).count() == 0
    assert line_rules.keep_quality(docs).columns == docs.columns


def test_lines_of_many_documents(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    line = "subscribe to our  Newsletter today and " + " ".join(word() for _ in range(60))
    body = [" ".join(word() for _ in range(70)) for _ in range(12)]
    rows = [(i, f"{b}\n{line if i % 2 else line.upper()}", "host") for i, b in enumerate(body)]
    rows += [(20, " ".join(word() for _ in range(55)) + "\n" + line + "\n" + line, "host"), (21, f"{body[0]}\n{line}", "elsewhere")]
    rows += [(30 + i, "copied " + rows[0][1][:300] + "\nand " + body[1], "copies") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sketches = [m.sketch for m in line_rules.measured(docs).orderBy("doc_id").collect()]
    expected = brute.line_verdicts(rows, sketches, 0.1, 5, 0.5)
    got = rows_of(line_rules.quality(docs, share=0.1, floor=5).orderBy("doc_id"), "removed_words", "kept")
    assert got == expected
    assert [x for x in got[12:14]] == [(132, False), (0, True)] and all(k for _, k in got[:12])
    assert len(set(sketches[14:])) == 1 and all(r == (0, True) for r in got[14:])  # copies count once
    assert {r.doc_id for r in line_rules.keep_quality(docs, share=0.1, floor=5).collect()} == {r[0] for r in rows} - {20}


def test_texts_that_share_most_of_their_words_are_different_documents(spark):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    passage = "\n".join(words(20) for _ in range(10))
    rows = [(i, f"{passage}\n{words(30)}", "depleted") for i in range(60)] + [(60 + i, words(80), "depleted") for i in range(20)]
    rows += [(100 + i, f"{passage}\n{rows[0][1]}", "copies") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = rows_of(line_rules.quality(docs).orderBy("doc_id"), "removed_words", "kept")
    assert got == brute.line_verdicts(rows, [t for _, t, _ in rows], 0.02, 20, 0.5)
    assert got[:80] == [(200, False)] * 60 + [(0, True)] * 20 and {n for n, _ in got[80:]} == {0}


def test_kept_texts_lose_their_frequent_lines(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    own = [(words(40), words(30)) for _ in range(30)]
    rows = [(i, f"\n{a}\n\n Read  MORE here\n{b}\nread more here \n", "host", -1, i) for i, (a, b) in enumerate(own)]
    rows += [(0, rows[0][1], "elsewhere", -1, 50), (None, rows[1][1], "host", -1, 51), (None, None, None, None, 52), (60, "read more here", "host", -1, 53)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int, extra int")
    left = [f"\n{a}\n\n{b}\n" for a, b in own]
    expected = [(i, x, "host", len(x), i) for i, x in enumerate(left)] + [rows[30], (None, left[1], "host", len(left[1]), 51)]
    got = line_rules.keep_quality(docs)
    assert got.dtypes == docs.dtypes
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    assert Counter(map(tuple, corpus_pipeline.keep_quality(spark, docs, "").collect())) == Counter(expected)


def test_kept_texts_beside_columns_of_any_name(spark):
    rng = random.Random(13)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    rows = [(i, f"{words(55)}\nthe same notice", "h", "g", "k") for i in range(30)] + [(99, "short", "h", "g", "k")]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, source string, c string, d string")
    docs = plain.withColumnsRenamed({"c": "_gone", "d": "Gone"}).withColumn("kept_text", F.lit(1)).withColumn("_kept_id", F.lit(2))
    got = line_rules.keep_quality(docs)
    assert got.columns == docs.columns
    expected = line_rules.keep_quality(plain).select("doc_id", "text").collect()
    assert sorted(map(tuple, got.select("doc_id", "text").collect())) == sorted(map(tuple, expected)) and len(expected) == 30


def test_small_hosts_lose_lines_too(spark):
    rng = random.Random(10)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    sizes = {3: 3, 4: 4, 10: 3, 20: 4, 50: 5, 51: 6, 199: 19, 200: 20, 210: 21}  # documents of a host: those with the line
    rows = [(f"{words(55)}\nthe same notice" if i < n else words(55), f"host{size}") for size, n in sizes.items() for i in range(size)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string, source string")
    got = Counter(rows[r.doc_id][1] for r in line_rules.quality(docs).filter("removed_words = 3").collect())
    assert got == {"host4": 4, "host20": 4, "host51": 6, "host210": 21}


# --- packing and token ids -------------------------------------------------------------------


def random_texts(n):
    rng = random.Random(7)
    letters = list("ab Z'1é\n\t  ,.!²İ́ \x1c　中s|<> \u0085")
    return ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize(("path", "byte_level"), [(BYTES, True), (WORDS, False)])
def test_encoder_equals_the_library(path, byte_level):
    texts = [t or "" for t in ODD] + random_texts(1500)
    encoder, got = WordEncoder(path, byte_level), []
    for _ in range(2):  # the second time from what it remembers
        got = []
        for _, flat, sizes in encoder.encode(pa.array(texts)):
            got += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def library_ids(path, texts):
    return [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_binary_lengths():
    assert packing.binary_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    assert packing.binary_lengths(0) == []
    assert all(sum(packing.binary_lengths(n, 64)) == n for n in range(300))


def test_packing(docs, empty):
    out = packing.numbered(scratch.written(packing.pieces(docs, WORDS, longest=64), "test-pieces")).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    assert [r.length for r in sorted(out, key=lambda r: r.sequence_id)] == sorted((r.length for r in out), reverse=True)
    got = Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in out)
    expected = Counter()
    source = docs.collect()
    for row, ids in zip(source, library_ids(WORDS, [r.text for r in source]), strict=True):
        ids, at = [*ids, 1], 0
        for n in packing.binary_lengths(len(ids), 64):
            expected[row.doc_id, at, len(ids), np.array(ids[at : at + n], "<u4").tobytes()] += 1
            at += n
    assert got == expected
    assert packing.pieces(empty, WORDS).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pieces(docs, WORDS, longest=100)


def test_perfect_hash():
    rng = np.random.default_rng(9)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, 20000))
    hashed = token_index.PerfectHash.of(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    assert token_index.PerfectHash.of(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


def test_token_shards(docs, empty, spark):
    folder = scratch.fresh(spark, "test-shards")
    manifest = token_index.write_shards(docs.repartition(3), BYTES, folder)
    got = sorted(token_index.read_shards(manifest).collect(), key=lambda r: r.start)
    source = [(r.doc_id, r.text) for r in docs.collect()]
    ids = [np.array([*x, 0], "<u4").tobytes() for x in library_ids(BYTES, [t for _, t in source])]
    assert Counter((r.doc_id, bytes(r.ids), r.n_tokens) for r in got) == Counter((i, x, len(x) // 4) for (i, _), x in zip(source, ids, strict=True))
    assert [r.doc_id for r in got] == sorted((i for i, _ in source), key=lambda i: (i is not None, i))  # no id first
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    found = Counter()
    for row in manifest.collect():
        store, path = pafs.FileSystem.from_uri(row.path)
        with store.open_input_file(path) as file:
            shard = token_index.TokenShard(file)
            assert shard.get(999) == [] and shard.get(-5) == []
            found.update((k, x.astype("<u4").tobytes()) for k in range(len(ODD)) for x in shard.get(k))
    assert found == Counter((i, x) for (i, _), x in zip(source, ids, strict=True) if i is not None)
    assert token_index.encode_to_shards(empty, BYTES).count() == 0


def test_one_id_fills_shards(spark, ship):
    """A repeated id and texts alike go to more than one shard, and no row is lost."""
    rows = [(5, f"text {i % 40}") for i in range(4000)] + [(None, "no id")] * 300 + [(i, "own") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_index.write_shards(docs, BYTES, scratch.fresh(spark, "test-shards"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 3
    got = sorted(token_index.read_shards(manifest).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_what_encoders_remember_is_bounded():
    encoder = WordEncoder(BYTES, True)
    encoder.known = words.Remembered(1 << 16)
    rng = random.Random(12)
    texts = ["".join(chr(rng.randint(0x4E00, 0x7E00)) for _ in range(n)) for n in [1000] * 30 + [8] * 2000]
    got = [x.tolist() for _, flat, sizes in encoder.encode(pa.array(texts)) for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == library_ids(BYTES, texts)
    kept = [*encoder.known.recent, *encoder.known.older]
    assert max(map(len, kept), default=0) <= words.LONGEST
    for _ in range(3):
        encoder.encode(pa.array(texts)).__next__()
    assert sum(len(k) for k in (*encoder.known.recent, *encoder.known.older)) < 1 << 16
    assert [x for s in words.sliced(["a", "bc", "d" * 9, "e"], 3) for x in s] == ["a", "bc", "d" * 9, "e"]


def test_transducer_and_merging(docs, empty):
    words = sorted({w.encode() for t in ODD[3:] for w in t.split()} | {b" the", b" then", b" them", b"them", b"\xff\x00"})
    merges = transducer.merge_table(BYTES)
    block = transducer.compiled(words, *merges.words(words))
    held = transducer.Transducer(block)
    assert held.numbers(words).tolist() == list(range(len(words)))
    assert held.numbers([b" th", b" themes", b"zz", b"\xff"]).tolist() == [-1] * 4
    edges, _ = transducer.minimal_automaton([b"bat", b"bats", b"cat", b"cats"])
    reached, left = set(), [0]
    while left:
        reached.add(state := left.pop())
        left += [c for c in edges[state].values() if c not in reached]
    assert len(reached) == 5  # after no letter, b or c, a, t, s: all words share what follows the first letter
    texts = [t or "" for t in ODD] + random_texts(1500) + ["".join(random.Random(i).choices("abcdeaaa", k=200)) for i in range(40)]
    for lexicon in (block, transducer.compiled([], *merges.words([]))):
        encoder, got, back = transducer.LexiconEncoder(BYTES, lexicon), [], []
        for _, flat, sizes in encoder.encode(pa.array(texts)):
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            got += [x.tolist() for x in parts]
            back += [merges.decoded(x).decode() for x in parts]
        assert got == library_ids(BYTES, texts)
        assert back == texts
    long = np.arange(300_000, dtype=np.uint32) % 50257
    assert merges.decoded(long) == b"".join(merges.spelt[s : s + n].tobytes() for s, n in zip(merges.starts[long], merges.sizes[long], strict=True))
    rows = transducer.encoded(docs, BYTES, 50).collect()
    source = docs.collect()
    expected = Counter((r.doc_id, np.array(x, "<u4").tobytes(), (r.text or "").encode()) for r, x in zip(source, library_ids(BYTES, [r.text for r in source]), strict=True))
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows) == expected
    assert transducer.encoded(empty, BYTES).count() == 0


# --- archives --------------------------------------------------------------------------------


def test_warc(spark, ship):
    page = "<html>" + "x" * 200 + "é</html>"
    rows = [(5, "http://a/", page), (3, "http://b/\r\nX: y", page), (9, None, page), (4, "u", "short"), (1, "u", "short"), (2, "u", None), (6, "u", "")]
    rows += [(7, "u", "\r\n\r\nWARC/1.1\r\n" * 20), (None, "u", page), (3, "again", page), (10, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(html) if first.get(html) != i else None
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    folder = scratch.fresh(spark, "test-warc")
    index = warc.write_bundles(pages.repartition(2), folder, frame_bytes=500)
    assert Counter(rows_of(warc.read_bundles(index), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected
    one = index.filter("page_id = 9").first()
    store, path = pafs.FileSystem.from_uri(one.bundle)
    with store.open_input_file(path) as file:
        found = warc.Bundle(file).record(one.frame, one.start, one.length)
    assert found["headers"]["warc-refers-to"] == "<urn:page:3>" and found["payload"] == b""
    assert warc.archive(pages.limit(0)).count() == 0


# --- toxicity --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_model(spark, ship):
    d = "/root/testdata/sf0.1"
    return toxicity.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def test_toxicity_held_out(spark, toxic_model):
    d = "/root/testdata/sf0.1"
    scored = toxicity.score(spark.read.parquet(f"{d}/documents.parquet"), toxic_model)
    rows = scored.filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("toxic", "predicted", "score").collect()
    toxic, clean = ([r for r in rows if r.toxic == y] for y in (1, 0))
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_of_odd_rows(docs, empty, toxic_model):
    got = toxicity.score(docs, toxic_model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    assert {r.predicted for r in got} == {0}
    assert toxicity.score(empty, toxic_model).count() == 0
    kept = toxicity.keep_clean(docs, toxic_model)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_toxicity_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, none)).count() == docs.count()
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 0, 7), (3, 0, 1), (3, 0, 1), (3, 0, 0), (500, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, odd)).count() == docs.count()
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


# --- search ----------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_of_odd_vectors(spark, ship, block):
    rng = random.Random(8)
    vectors = [(i, [rng.choice([0.0, 0.01, -0.5, 0.3, 1.0]) for _ in range(6)]) for i in range(60)]
    vectors += [(20, [0.5] * 6), (100, None), (120, [0.1, None]), (140, [float("nan")] * 6), (160, [float("inf")]), (None, [1.0]), (180, []), (181, [2.0]), (200, [1e9] * 6)]
    frame = spark.createDataFrame([(*v, "clash") for v in vectors], "vec_id bigint, embedding array<float>, score string")
    whole = topk.quantised(frame)
    held = [(r.vec_id, r.weights) for r in whole.collect()]
    assert sorted(i for i, _ in held) == sorted([*range(60), 20, 180, 181, 200])
    asked = [v for v in held if v[0] % 20 == 0 and v[0] != 20]
    got = topk.top_k(whole.filter("vec_id % 20 = 0 AND vec_id <> 20"), whole, 5, block).collect()
    expected = []
    for q, x in asked:
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in held if i != q)
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert topk.top_k(whole.limit(0), whole).count() == topk.top_k(whole, whole.limit(0)).count() == 0
    assert topk.top_k(whole.filter("vec_id = 0"), whole.filter("vec_id < 4"), 9).count() == 3


def test_repeated_queries_are_asked_with_each_of_their_vectors(spark, ship):
    vectors = [(20, [1, 0]), (20, [0, 1]), (20, [0, 1]), (1, [9, 1]), (2, [1, 8]), (3, [7, 7]), (4, [0, 0])]
    whole = spark.createDataFrame(vectors, "vec_id bigint, weights array<bigint>")
    found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for q, x in vectors if q == 20 for i, y in vectors if i != 20)
    for k in (2, 5, 20):
        got = topk.top_k(whole.filter("vec_id = 20"), whole, k).collect()
        assert sorted(map(tuple, got)) == [(20, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)]


def test_top_k_copies_no_candidates(spark, ship, monkeypatch):
    """Tasks read the blocks of candidates from files: none is joined to queries, however many blocks there are."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "UNIT", 6, raising=False)
    rng = random.Random(5)
    kinds = [[0, 0, 0, 1, -2, 9], [0] * 9 + [7], [5000, -9000, 1], [1 << 25, -3, 0], [1 << 40, -(1 << 50), 1]]
    vectors = [(i % 90, [rng.choice(kinds[i % 5]) for _ in range(rng.randint(0, 40))]) for i in range(120)]
    whole = spark.createDataFrame(vectors, "vec_id bigint, weights array<bigint>").repartition(5)
    got = topk.top_k(whole.filter("vec_id % 4 = 0"), whole, 6, 10)
    assert not any("candidate-blocks" in f for f in got.inputFiles())
    wrapped = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    expected = []
    for q in range(0, 90, 4):
        found = [[(-wrapped(sum(a * b for a, b in zip(x, y, strict=False))), i) for i, y in vectors if i != q] for j, x in vectors if j == q]
        best = sorted(s for own in found for s in sorted(own)[:6])[:6]
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_components_beyond_whole_numbers(spark, ship):
    vectors = [(1, [1e300, -1e300, 0.5]), (2, [1.7e308]), (3, [-0.001]), (4, [None]), (5, []), (None, [1.0]), (6, None)]
    got = topk.quantised(spark.createDataFrame(vectors, "vec_id int, embedding array<double>")).collect()
    top = (1 << 63) - 1
    assert sorted((r.vec_id, r.weights) for r in got) == [(1, [top, -top - 1, 32]), (2, [top]), (3, [-1]), (5, [])]


# --- preferences -----------------------------------------------------------------------------


def test_preference_pairs(spark):
    schema = "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"
    a, b = [("user", "hi <|end|>"), ("assistant", "yes")], [("user", "hi <|end|>"), ("assistant", "no"), ("user", "?"), ("assistant", "é😀")]
    rows = [(1, a, b, "clash"), (2, a, a, ""), (3, a, None, ""), (4, None, None, ""), (5, a, a[:1], "")]
    out = {r.id: r for r in preference.preference_pairs(spark.createDataFrame(rows, schema)).collect()}
    assert out[1].prompt == "<|user|>\nhi < |end|><|end|>\n" and out[1].prompt_turns == 1
    for row in out.values():
        for side, turns in (("chosen", row.chosen), ("rejected", row.rejected)):
            text, spans = row[f"{side}_text"], row[f"{side}_spans"]
            said = [t.text for t in (turns or [])[row.prompt_turns :] if t.role == "assistant"]
            assert [text[s.start : s.start + s.length] for s in spans] == [f"{x}<|end|>\n" for x in said]
    assert [(out[i].prompt_turns, out[i].chosen_text == "", out[i].rejected_text == "") for i in (2, 3, 4, 5)] == [(2, True, True), (0, False, True), (0, True, True), (1, False, True)]


def test_next_with_key_crosses_blocks(spark):
    ids = [(k, i) for k in (1, 2) for i in range(k, 5000, 7 * k)] + [(3, 9)]
    got = {(r.key, r.id): r.next_id for r in preference.next_with_key(spark.createDataFrame(ids, "key int, id bigint"), 64).collect()}
    for k in (1, 2, 3):
        own = sorted(i for x, i in ids if x == k)
        assert [got[k, i] for i in own] == [*own[1:], None]


def test_pairs_of_conversations(spark):
    rows = [(c, t, r, x) for c in range(6) for t, r, x in ((0, "user", f"q{c % 2}"), (1, "assistant", f"a{c}"), (2, "user", "more"), (3, "assistant", f"b{c}"))]
    rows += [(7, None, None, None), (7, 1, "assistant", "only"), (8, 0, "user", "alone"), (None, 0, "user", "q0"), (9, 0, "assistant", "x"), (9, 0, "assistant", "x")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, chosen int")
    got = {r.conv_id: r for r in preference.paired(frame).collect()}
    assert {c: r.rejected_id for c, r in got.items()} == {0: 2, 1: 3, 2: 4, 3: 5, 4: None, 5: None, 7: None, 8: None, 9: None}
    assert [t.text for t in got[4].rejected] == ["q0", "a4", "more", "a4"]
    assert [t.text for t in got[7].rejected] == ["", ""] and [t.text for t in got[9].rejected] == ["x", "x"]
    assert preference.preference_pairs(preference.paired(frame.limit(0))).count() == 0


# --- the whole -------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name, monkeypatch):
    kinds = compare.kinds
    monkeypatch.setattr(compare, "kinds", lambda types: {c: "int" if t == "INTEGER" else kinds({c: t})[c] for c, t in types.items()})
    assert compare.difference(spark, compare.connect(Path(sf_dir)), queries.registered()[name], queries.oracle_sql()[name], Path(sf_dir)) is None


def test_pipeline_stages(spark, sf_dir, docs, empty):
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = whole
    for name, stage in corpus_pipeline.STAGES:
        given = rows
        rows = scratch.written(stage(spark, given, sf_dir), f"test-{name}")
        ids = {r.doc_id for r in rows.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in given.select("doc_id").collect()} and ids
        if name == "toxicity":
            model = toxicity.fit(whole, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert ids == {r.doc_id for r in toxicity.score(whole, model).filter("predicted = 0").collect()}
        if name == "quality":
            assert ids == {r.doc_id for r in line_rules.quality(given).filter("kept").collect()}
        if name == "near_duplicates":
            assert ids == {r.component_id for r in simhash.near_duplicates(given).collect()} and rows.count() == len(ids)
        if name != "packing":
            assert rows.columns == whole.columns
    assert rows.agg(F.sum("length")).first()[0] == rows.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    for given in (docs, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, given, sf_dir).count() >= 0


def test_words_are_encoded_without_sweeps(monkeypatch):
    """The search for cycles is off while a part is encoded, and on again between parts and after a failure."""
    encoder, seen, plain_part = WordEncoder(BYTES, True), [], WordEncoder.part

    def part(self, texts):
        seen.append(gc.isenabled())
        return plain_part(self, texts)

    monkeypatch.setattr(WordEncoder, "part", part)
    assert gc.isenabled()
    for _, ids, lengths in encoder.encode(pa.array(["some words, some more", None, ""])):
        assert gc.isenabled() and lengths.tolist() == [len(ids), 0, 0]
    assert seen == [False]
    with pytest.raises(ZeroDivisionError), words.unswept():
        1 / 0
    assert gc.isenabled()


def test_numbered_chunks_are_their_texts():
    values = pa.array(["", "a", "", "a", "é\0b", ""], pa.large_string())
    first = np.array([True, True, False, False, False, False])
    texts, codes = WordEncoder.numbered(values, first)
    assert [texts[c] for c in codes] == ["", "a", " ", " a", " é\0b", " "] and len(set(texts)) == len(texts)
    assert WordEncoder.numbered(values.slice(0, 0), first[:0])[0] == []


def test_merges_look_up_changed_pairs_only(monkeypatch):
    merges, looked_up, plain_look_up = transducer.Merges(BYTES), [], transducer.Merges._look_up

    def look_up(self, pairs):
        looked_up.append(len(pairs))
        return plain_look_up(self, pairs)

    monkeypatch.setattr(transducer.Merges, "_look_up", look_up)
    rng = random.Random(3)
    odd = [bytes(rng.choices(b"aab e\xc3\xa9th", k=rng.randint(1, 70))) for _ in range(2000)] + [b"a" * n for n in range(1, 80)] + [b" the"]
    ids, sizes = merges.words(odd)
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [merges.long_word(w) for w in odd]
    merged = sum(len(w) for w in odd) - len(ids)
    assert sum(looked_up) <= 2 * merged  # two neighbours of each merge; those of bytes are in a table
    assert [x.tolist() for x in merges.words([])] == [[], []]


def test_counted_chunks_are_cut_once(monkeypatch):
    cut, plain_cut = Counter(), transducer.words_of

    def words_of(chunk, split, special):
        cut[chunk] += 1
        return plain_cut(chunk, split, special)

    monkeypatch.setattr(transducer, "words_of", words_of)
    monkeypatch.setattr(transducer._Counter, "part_bytes", 16)
    counter = transducer._Counter(BYTES)
    texts = ["now, then <|endoftext|>now", "now, then", "äpfel now, 12"] * 5
    for _ in counter.encode(pa.array(texts)):
        pass
    counter.cut_up()
    assert set(cut.values()) == {1}
    assert counter.seen == {"now": 15, ",": 15, " then": 10, " ": 5, "äpfel": 5, " now": 5, " 12": 5}
