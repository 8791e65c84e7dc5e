"""Registered queries of this subpackage, and the same results as DuckDB SQL where SQL can say them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm import alignment, line_rules, packing, periodic, preference, secrets, sharding, simhash, token_index, topk, toxicity, transducer, warc
from noteloom.llm.scratch import ship, written

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document."""
    return sharding.shard_records(table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and quality verdict of every document."""
    return line_rules.quality(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of binary lengths."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.numbered(written(digests, "pieces"))


@query
def op9_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to indexed shards and read back."""
    rows = token_index.encode_to_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to WARC bundles and read back."""
    return warc.archive(table(spark, sf_dir, "pages"))


_ORACLES["op5_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id FROM payloads
)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.score(docs, toxicity.fit(docs, labels))


@query
def op7_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents by automaton and exact merging, and their decoded texts, as digests."""
    rows = transducer.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by integer inner product, of each vector whose id is divisible by 20."""
    return topk.self_search(table(spark, sf_dir, "embeddings"))


_ORACLES["op8_topk"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q, vectors c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preference pair for every conversation; spans as ``start:length`` text."""
    pairs = preference.preference_pairs(preference.paired(table(spark, sf_dir, "conversations")))
    return pairs.select(
        "conv_id",
        "rejected_id",
        F.col("prompt_turns").cast("bigint").alias("prompt_turns"),
        "prompt",
        "chosen_text",
        "rejected_text",
        *[
            F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["length"].cast("string"))), ",").alias(c)
            for c in ("chosen_spans", "rejected_spans")
        ],
    )


_ORACLES["op10_preference"] = r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), follow AS (
  SELECT conv_id, t, lead(conv_id) OVER (PARTITION BY t[1] ORDER BY conv_id) AS rejected_id FROM turns
), own AS (
  SELECT *, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS places FROM follow
), pairs AS (
  SELECT o.conv_id, o.rejected_id, o.t AS c,
    CASE WHEN o.rejected_id IS NOT NULL THEN n.t
      ELSE list_transform(range(1, len(o.t) + 1), lambda i: {'role': o.t[i].role,
        'text': CASE WHEN i = o.places[-1] THEN coalesce(o.t[o.places[-2]].text, '') ELSE o.t[i].text END}) END AS r
  FROM own o LEFT JOIN turns n ON n.conv_id = o.rejected_id
), cut AS (
  SELECT *, coalesce(list_position(list_transform(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] IS NOT DISTINCT FROM r[i]), false) - 1,
    greatest(len(c), len(r))) AS p FROM pairs
), parts AS (
  SELECT conv_id, rejected_id, p, c[1:p] AS head, c[p + 1:] AS c, r[p + 1:] AS r FROM cut
), written AS (
  SELECT conv_id, rejected_id, p, head, c, r,
    list_transform(head, lambda x: '<|' || replace(x.role, '<|', '< |') || '|>' || chr(10) || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)) AS wh,
    list_transform(c, lambda x: '<|' || replace(x.role, '<|', '< |') || '|>' || chr(10) || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)) AS wc,
    list_transform(r, lambda x: '<|' || replace(x.role, '<|', '< |') || '|>' || chr(10) || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)) AS wr
  FROM parts
)
SELECT conv_id, rejected_id, p AS prompt_turns,
  array_to_string(wh, '') AS prompt, array_to_string(wc, '') AS chosen_text, array_to_string(wr, '') AS rejected_text,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i:
    CAST(length(array_to_string(wc[1:i - 1], '')) + length(replace(c[i].role, '<|', '< |')) + 5 AS VARCHAR) || ':' ||
    CAST(length(replace(c[i].text, '<|', '< |')) + 8 AS VARCHAR)), ',') AS chosen_spans,
  array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'), lambda i:
    CAST(length(array_to_string(wr[1:i - 1], '')) + length(replace(r[i].role, '<|', '< |')) + 5 AS VARCHAR) || ':' ||
    CAST(length(replace(r[i].text, '<|', '< |')) + 8 AS VARCHAR)), ',') AS rejected_spans
FROM written
"""


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies, aligned by bytes, with scores of its links from the whole corpus."""
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    rows = written(alignment.aligned(table(spark, sf_dir, "documents"), *paths, digest=True), "aligned")
    scored = alignment.scored(rows, alignment.pair_counts(rows))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: numbers by pattern, a digest of the patterns' spans, and all spans."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    base = f"filter(spans, s -> s.kind IN ({', '.join(map(repr, secrets.BASE_KINDS))}))"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(F.expr(secrets.written_spans(base)), 256).alias("base_sha256"),
        F.expr(secrets.written_spans("spans")).alias("spans"),
    )


def with_echo(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a hash of the id, go on from some word with a short stretch again and again."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, the longest of them, and digests of all runs and of the words left."""
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), with_echo)
    found = found.withColumn("longest", F.expr(periodic.longest_run()))
    lines = "transform(runs, r -> concat(cast(r.start AS string), ',', cast(r.length AS string), ',', cast(r.period AS string), '\n'))"
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join({lines}, '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the pipeline over the documents."""
    import corpus_pipeline  # at the top of the repository, and built on this subpackage

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
