"""Toxicity by weak supervision: many voters, a label model over their votes, a linear classifier on its posteriors.

Voters are word lists and patterns.  One list is given; the others are word beginnings of several lengths, and
whole words, that toxic training rows have far more often than others.  The label model is generative: each voter fires
with one probability in toxic and another in clean documents, fitted by expectation maximisation over the votes
on all documents; voters that fire together beyond what the label explains share their weight.  A logistic
regression is then fitted to the model's posteriors, on how dense each listed term and each voter is in a text.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common insults, and patterns of heated text
INSULTS = (
    "bastard clown coward creep crook cretin disgusting dumb fool freak garbage hypocrite idiot idiotic imbecile jerk "
    "liar loser moron nasty pathetic pig rat rubbish scum stupid swine trash ugly useless vermin vile worthless"
).split()
PATTERNS = {"shouting": r"\b[A-Z]{4,}\b", "exclaiming": r"!!+", "masking": r"\b[A-Za-z]+\*+[A-Za-z]*\b", "addressing": r"(?i)\byou(?:'re| are)\b"}

SAMPLE = 6000  # labelled rows that the lists and the classifier are fitted on, half of each label if there are so many
TERMS = 400  # longest list of mined terms
PREFIXES = (4, 5, 6, 7)
WHOLE = 8  # stands for whole words among the lengths
RATIO = 8.0  # how much denser a mined term must be in toxic rows
GROUPS = ("insults", *PREFIXES, WHOLE)
LEVELS = ("any", "more", "dense")
DENSE = 0.01  # of a text's words
STEPS, RIDGE = 400, 2e-3
SMOOTH = 10  # words added to a text's length
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¿¡"
PART_BYTES = 8 << 20


def held_out() -> Column:
    """Rows that no label is learnt from: crc32 of the id's digits is divisible by five."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def terms_of(word: str) -> list[tuple[int, str]]:
    """The beginnings of a word and the word itself, each with its length or ``WHOLE``."""
    return [*((n, word[:n]) for n in PREFIXES if len(word) > n), (WHOLE, word)]


class Texts:
    """The words of some texts: which distinct word stands where, and how many each text has."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = lists.flatten().dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.words = [w.strip(EDGES) for w in coded.dictionary.to_pylist()]
        filled = np.fromiter(map(bool, self.words), bool, len(self.words))[self.codes]
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.of = np.repeat(np.arange(len(counts)), counts)[filled]
        self.codes = self.codes[filled]
        self.sizes = np.bincount(self.of, minlength=len(counts))

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a value for each distinct word."""
        return np.bincount(self.of, values[self.codes], minlength=len(self.sizes))


def parts(texts: pa.Array) -> Iterator[tuple[slice, pa.Array]]:
    """Some texts after the other, null ones as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > start:
            yield slice(start, end), texts.slice(start, end - start)


class Voters:
    """The lists, and what each says of a text."""

    def __init__(self, terms: list[str]):
        self.terms = terms  # "length:text"
        self.number = {t: i for i, t in enumerate(terms)}
        self.insults = frozenset(INSULTS)
        self.names = [f"{g}:{level}" for g in GROUPS for level in LEVELS] + list(PATTERNS) + ["nothing"]

    def hits(self, word: str) -> list[int]:
        """Numbers of the listed terms that a word has; insults are one more."""
        found = [n for length, t in terms_of(word) if (n := self.number.get(f"{length}:{t}")) is not None]
        return [*found, len(self.terms)] if word in self.insults else found

    def matrix(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and count of all hits."""
        hits = [(i, n) for i, w in enumerate(texts.words) for n in self.hits(w)]
        if not hits or not len(texts.codes):
            return (np.zeros(0, np.int64),) * 3
        word, term = np.array(hits, np.int64).T
        per_word = np.bincount(word, minlength=len(texts.words))
        start = np.cumsum(per_word) - per_word
        many = per_word[texts.codes]
        some = many > 0
        codes, of, many = texts.codes[some], texts.of[some], many[some]
        before = np.cumsum(many) - many
        at = np.repeat(start[codes] - before, many) + np.arange(int(many.sum()))
        width = len(self.terms) + 1
        pairs, counts = np.unique(np.repeat(of, many) * width + term[at], return_counts=True)
        return pairs // width, pairs % width, counts

    def look(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
        """``(fires, dense features, hits)`` of some texts: what fires is one bit a voter."""
        words = Texts(texts)
        text, term, count = hits = self.matrix(words)
        n = words.sizes.astype(np.float64)
        kind = np.array([GROUPS.index(int(t.split(":", 1)[0])) for t in self.terms] + [0])
        group = np.zeros((len(n), len(GROUPS)))
        np.add.at(group, (text, kind[term]), count)
        found = [pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False).astype(np.float64) for p in PATTERNS.values()]
        pattern = np.stack(found, axis=1) if len(n) else np.zeros((0, len(PATTERNS)))
        levels = np.stack([group >= 1, group >= 2, (group >= 1) & (group >= DENSE * n[:, None])], axis=2).reshape(len(n), -1)
        fires = np.concatenate([levels, pattern >= 1, ~group.any(axis=1)[:, None]], axis=1)
        share = 1 / (n[:, None] + SMOOTH)
        features = np.concatenate([levels, np.minimum(100 * group * share, 10), np.minimum(100 * pattern * share, 10)], axis=1)
        return fires, features, (text, term, 100 * count * share[text, 0])


def _mask(fires: np.ndarray) -> np.ndarray:
    return fires.astype(np.int64) @ (np.int64(1) << np.arange(fires.shape[1], dtype=np.int64))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``(text, toxic)`` of at most ``size`` training rows, half of each label as far as there are; equal texts once.

    Ids are drawn by hash from the labels; at most ``size`` of them are broadcast to the documents.
    """
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out()).select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [usable.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size // 2) for y in (0, 1)]
    ids = drawn[0].unionByName(drawn[1])
    return docs.select(F.col("doc_id").cast("bigint"), "text").join(F.broadcast(ids), "doc_id").select("text", "toxic").distinct()


def mined_terms(sample: DataFrame, limit: int = TERMS) -> list[str]:
    """Terms at least ``RATIO`` times denser in toxic rows, by how much more often toxic rows have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter() for _ in range(4)]  # toxic rows and words, clean rows and words
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            totals = np.zeros(4, np.int64)
            for rows, texts in parts(batch.column(0)):
                words = Texts(texts)
                totals += [int(x) for y in (1, 0) for x in ((toxic[rows] == y).sum(), words.sizes[toxic[rows] == y].sum())]
                pairs, n = np.unique(words.of * max(len(words.words), 1) + words.codes, return_counts=True)
                own: dict[int, Counter] = {}
                for pair, times in zip(pairs.tolist(), n.tolist(), strict=True):
                    text, code = divmod(pair, len(words.words))
                    terms = own.setdefault(text, Counter())
                    for length, term in terms_of(words.words[code]):
                        terms[f"{length}:{term}"] += times
                for text, terms in own.items():
                    side = 0 if toxic[rows][text] == 1 else 2
                    counts[side].update(terms.keys())
                    counts[side + 1].update(terms)
            keys = list(counts[0] | counts[2])
            columns = [["", *keys], *([int(t), *(c[k] for k in keys)] for t, c in zip(totals, counts, strict=True))]
            kinds = [pa.string(), *[pa.int64()] * 4]
            names = ["term", "toxic_rows", "toxic_words", "clean_rows", "clean_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "term string, toxic_rows bigint, toxic_words bigint, clean_rows bigint, clean_words bigint"
    names = ["toxic_rows", "toxic_words", "clean_rows", "clean_words"]
    counted = sample.mapInArrow(run, schema).groupBy("term").agg(*[F.sum(n).alias(n) for n in names]).persist()
    total = counted.filter("term = ''").first()
    if total is None or not total["toxic_rows"] or not total["clean_rows"]:
        return []
    density = (F.col("toxic_words") / F.lit(float(total["toxic_words"] or 1))) / ((F.col("clean_words") + 0.5) / F.lit(float(total["clean_words"] or 1)))
    lead = F.col("toxic_rows") / F.lit(float(total["toxic_rows"])) - F.col("clean_rows") / F.lit(float(total["clean_rows"]))
    least = max(3.0, 0.02 * total["toxic_rows"])
    picked = counted.filter((F.col("term") != "") & (F.col("toxic_rows") >= least) & (density >= RATIO)).withColumn("lead", lead)
    terms = [r["term"] for r in picked.orderBy(F.desc("lead"), "term").limit(limit).select("term").collect()]
    counted.unpersist()
    return terms


class LabelModel:
    """How likely each voter fires in toxic and in clean documents, the share of toxic ones, and each voter's weight."""

    def __init__(self, fires: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int = 25):
        """``fires``: distinct sets of votes, ``counts``: how many documents have each, ``start``: first guesses of their posterior."""
        x, posterior = fires.astype(np.float64), start
        for _ in range(rounds):
            toxic, clean = counts * posterior, counts * (1 - posterior)
            self.share = (toxic.sum() + 1) / (counts.sum() + 2)
            self.rates = [(y @ x + 1) / (y.sum() + 2) for y in (toxic, clean)]
            self.weights = 1 / (1 + self._bonds(x, toxic, clean))
            posterior = self.posterior(fires)

    def _bonds(self, x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """For each voter, the sum of its correlations with the others that the label leaves."""
        within = np.zeros((x.shape[1], x.shape[1]))
        for y, rate in zip((toxic, clean), self.rates, strict=True):
            apart = x - rate
            within += (apart * y[:, None]).T @ apart
        spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
        bonds = np.abs(within / np.outer(spread, spread))
        np.fill_diagonal(bonds, 0)
        return bonds.sum(axis=1)

    def posterior(self, fires: np.ndarray) -> np.ndarray:
        on = np.log(self.rates[0] / self.rates[1])
        off = np.log((1 - self.rates[0]) / (1 - self.rates[1]))
        odds = np.log(self.share / (1 - self.share)) + np.where(fires, on, off) @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fitted_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam on the whole sample, features scaled to unit spread."""
    scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(x.shape[1])
    z = x / scale
    w, b = np.zeros(x.shape[1]), 0.0
    moments = np.zeros((2, x.shape[1] + 1))
    for step in range(1, STEPS + 1):
        gap = weight * (1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y)
        slope = np.append(z.T @ gap / weight.sum() + RIDGE * w, gap.sum() / weight.sum())
        moments = np.array([[0.9], [0.99]]) * moments + np.array([[0.1], [0.01]]) * np.array([slope, slope**2])
        move = 0.1 * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w / scale, float(b)


class Model:
    """The voters with the weights of the classifier; small, and sent to every task."""

    def __init__(self, terms: list[str], line: np.ndarray, bias: float):
        self.terms, self.line, self.bias = terms, line, bias
        self.voters = Voters(terms)

    def __reduce__(self):
        return Model, (self.terms, self.line, self.bias)

    def scores(self, texts: pa.Array) -> np.ndarray:
        _, features, (text, term, value) = self.voters.look(texts)
        width = features.shape[1]
        odds = self.bias + features @ self.line[:width] + np.bincount(text, value * self.line[width + term], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def votes(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``(mask, n)``: which voters fire together, over all documents.  No more rows than there are sets of voters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(terms)
        for batch in batches:
            for _, texts in parts(batch.column(0)):
                masks, n = np.unique(_mask(voters.look(texts)[0]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array(n.astype(np.int64))], ["mask", "n"])

    return docs.select("text").mapInArrow(run, "mask bigint, n bigint").groupBy("mask").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """Fit voters, label model and classifier.  ``docs`` is ``(doc_id, text)``, ``labels`` ``(doc_id, toxic)``.

    What is fitted on labels sees at most ``size`` rows; the label model sees the votes on every document.  Labels that are
    null or neither 0 nor 1 are not used, nor are those of held-out rows; an id with both counts as toxic.  Without
    labels of both kinds only the given list and patterns vote.
    """
    sample = labelled_sample(docs, labels, size).persist()
    terms = mined_terms(sample)
    voters = Voters(terms)
    width = len(voters.names) - 1 + len(GROUPS)  # features beside the terms
    held = votes(docs, terms).collect()
    if not held:
        sample.unpersist()
        return Model(terms, np.zeros(width + len(terms) + 1), 0.0)
    masks, counts = np.array([r["mask"] for r in held], np.int64), np.array([r["n"] for r in held], np.float64)
    fires = (masks[:, None] >> np.arange(len(voters.names)) & 1).astype(bool)
    more = [i for i, n in enumerate(voters.names) if n.endswith((":more", ":dense"))]
    # at first, documents in which two voters of more than one hit fire are held to be toxic
    label_model = LabelModel(fires, counts, np.where(fires[:, more].sum(axis=1) >= 2, 0.95, 0.02))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Voters(terms)
        for batch in batches:
            for rows, texts in parts(batch.column(0)):
                fired, dense, (text, term, value) = own.look(texts)
                cut = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
                lists = [json.dumps([term[s:e].tolist(), value[s:e].tolist()]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
                columns = [pa.array(_mask(fired)), pa.array(dense.tolist(), pa.list_(pa.float64())), pa.array(lists, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(rows.start, len(texts)), *columns], ["toxic", "mask", "dense", "hits"])

    taken = sample.mapInArrow(features, "toxic int, mask bigint, dense array<double>, hits string").collect()
    sample.unpersist()
    if not taken:  # no labels: learn from the sets of votes alone
        return Model(terms, np.zeros(width + len(terms) + 1), float(np.log(label_model.share / (1 - label_model.share))))
    x = np.zeros((len(taken), width + len(terms) + 1))
    for i, row in enumerate(taken):
        x[i, :width] = row["dense"]
        term, value = json.loads(row["hits"])
        x[i, [width + t for t in term]] = value
    fired = (np.array([r["mask"] for r in taken], np.int64)[:, None] >> np.arange(len(voters.names)) & 1).astype(bool)
    soft = label_model.posterior(fired)
    # the sample has more toxic rows than the corpus: weigh them back to the model's share
    weight = np.where(soft >= 0.5, label_model.share / max(soft.mean(), 1e-3), (1 - label_model.share) / max(1 - soft.mean(), 1e-3))
    return Model(terms, *fitted_line(x, soft, weight))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``(doc_id, text)``.

    Null and empty texts are scored as a text without words; repeated rows and null ids as any other, long texts
    whole.  Other columns are ignored, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(texts) for _, texts in parts(batch.column(1))]
            made = np.concatenate([np.zeros(0), *found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns, without a shuffle."""
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(texts) for _, texts in parts(batch.column(column))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *found]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
