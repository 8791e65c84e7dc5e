"""Inputs of the registered queries, derived from the given tables.

The tables hold no clinical text, so notes with their annotations are written from ``events``.
Every SELECT here means the same in Spark SQL and in DuckDB, where the oracles use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.functions.vocabulary import BREEDS, DIAGNOSES

NOTES = """
SELECT event_id AS record_id,
  'Pt seen ' || CASE event_id % 4 WHEN 0 THEN 'BAR' WHEN 1 THEN 'qar' WHEN 2 THEN 'BARH' ELSE 'NAD' END
  || ', ' || CASE event_id % 6 WHEN 0 THEN '4yo' WHEN 1 THEN '6 months' WHEN 2 THEN '8wk' WHEN 3 THEN '6 mo' WHEN 4 THEN CAST(user_id % 14 + 1 AS STRING) || ' yrs' ELSE 'adult' END
  || ' ' || CASE event_id % 5 WHEN 0 THEN 'MN' WHEN 1 THEN 'FS' WHEN 2 THEN 'fn' WHEN 3 THEN 'ME' ELSE '' END
  || ' ' || CASE user_id % 4 WHEN 0 THEN CAST(user_id % 45 + 1 AS STRING) || 'kg' WHEN 1 THEN CAST(user_id % 9 AS STRING) || '.5 Kg' WHEN 2 THEN '900 g' ELSE '' END
  || '. Hr=' || CAST(60 + user_id % 90 AS STRING) || ' CRT 1 BP:120 T=' || CAST(35 + event_id % 8 AS STRING) || '.' || CAST(user_id % 10 AS STRING)
  || '. Given ' || CAST(user_id % 20 + 1 AS STRING) || CASE event_id % 3 WHEN 0 THEN 'mg/kg BID' WHEN 1 THEN ' ml PO' ELSE ' IU' END
  || CASE event_id % 9
       WHEN 0 THEN '. Tel 07' || LPAD(CAST(user_id * 7919 % 1000 AS STRING), 3, '0') || ' ' || LPAD(CAST(user_id * 104729 % 1000000 AS STRING), 6, '0')
       WHEN 1 THEN '. Mail owner.' || CAST(user_id AS STRING) || '@example.org'
       WHEN 2 THEN '. From L' || CAST(user_id % 9 + 1 AS STRING) || ' ' || CAST(user_id % 8 + 1 AS STRING) || 'QX'
       WHEN 3 THEN '. Chip 9' || LPAD(CAST(user_id * 1299709 AS STRING), 14, '0')
       WHEN 4 THEN '. Recheck 0' || CAST(user_id % 9 + 1 AS STRING) || '/11/2024 and 0' || CAST(user_id % 9 + 1 AS STRING) || '/11/2024 then 3-Feb-25'
       WHEN 5 THEN '. Seen by ' || LPAD(CAST(user_id AS STRING), 6, '4') || ' MRCVS'
       WHEN 6 THEN '. Call 01234 567890 MRCVS'
       WHEN 7 THEN '. Owner Mrs Hale of Leeds'
       ELSE '' END AS raw_text,
  CASE event_id % 7 WHEN 0 THEN 'OA' WHEN 1 THEN 'Otitis extena' WHEN 2 THEN 'abcess' WHEN 3 THEN 'GI upset' WHEN 4 THEN 'Vomitting' WHEN 5 THEN 'sore paw' ELSE NULL END AS disease,
  CASE event_id % 9
    WHEN 0 THEN '07' || LPAD(CAST(user_id * 7919 % 1000 AS STRING), 3, '0') || ' ' || LPAD(CAST(user_id * 104729 % 1000000 AS STRING), 6, '0')
    WHEN 1 THEN 'owner.' || CAST(user_id AS STRING) || '@example.org'
    WHEN 2 THEN 'L' || CAST(user_id % 9 + 1 AS STRING) || ' ' || CAST(user_id % 8 + 1 AS STRING) || 'QX'
    WHEN 3 THEN '9' || LPAD(CAST(user_id * 1299709 AS STRING), 14, '0')
    WHEN 4 THEN '0' || CAST(user_id % 9 + 1 AS STRING) || '/11/2024'
    WHEN 5 THEN LPAD(CAST(user_id AS STRING), 6, '4')
    WHEN 6 THEN '01234 567890'
    WHEN 7 THEN 'Hale|LEEDS'
    ELSE CASE WHEN event_id % 2 = 0 THEN 'Novaa' ELSE '' END END AS gold,
  CASE WHEN event_id % 3 <> 0 THEN 'chapter ' || CAST(event_id % 5 AS STRING) ELSE '' END AS icd
FROM events
"""

# Annotated source rows: lists as text, some empty, missing, cut off or broken.
SOURCE = f"""
SELECT CAST(record_id AS STRING) AS id, raw_text AS sentence,
  CASE WHEN icd = '' THEN '[]' ELSE '[' || chr(39) || icd || chr(39) || ', ' || chr(34) || 'it' || chr(39) || 's other' || chr(34) || ']' END AS icd_label,
  CASE WHEN gold = '' THEN NULL
    ELSE '[{{' || chr(39) || 'entity' || chr(39) || ': ' || chr(39) || gold || chr(39) || ', ' || chr(39) || 'label' || chr(39) || ': None}}]' END AS annonymisation,
  CASE WHEN disease IS NULL THEN CASE WHEN record_id % 2 = 0 THEN '[]' ELSE '' END
    WHEN record_id % 5 = 0 THEN '[{{' || chr(39) || 'entity' || chr(39) || ': ' || chr(39) || disease || chr(39) || '}}'
    WHEN record_id % 5 = 1 THEN '[{{' || chr(34) || 'entity' || chr(34) || ': ' || chr(34) || disease || chr(34) || ', '
      || chr(39) || 'label' || chr(39) || ': None, ' || chr(39) || 'start' || chr(39) || ': 3}}]'
    WHEN record_id % 5 = 2 THEN '[{{' || chr(39) || 'entity' || chr(39) || ': ' || chr(39) || disease
    ELSE '[{{' || chr(39) || 'entity' || chr(39) || ': ' || chr(39) || disease || chr(39) || ', ' || chr(39) || 'start' || chr(39) || ': 3, '
      || chr(39) || 'end' || chr(39) || ': 9}}, {{' || chr(39) || 'entity' || chr(39) || ': ' || chr(39) || 'owner' || chr(92) || chr(39)
      || 's word: None' || chr(39) || ', ' || chr(39) || 'label' || chr(39) || ': ' || chr(39) || 'X' || chr(39) || '}}]' END AS disease
FROM notes
"""


def misspelt(names: list[str], positions: int) -> str:
    """Names with one letter dropped, replaced or doubled, the way a row of ``events`` says."""
    values = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    spot = f"CAST(user_id % {positions} AS INT)"
    return f"""
SELECT event_id AS record_id,
  CASE event_id % 3
    WHEN 0 THEN substr(name, 1, {spot} + 1) || substr(name, {spot} + 3)
    WHEN 1 THEN substr(name, 1, {spot} + 1) || 'x' || substr(name, {spot} + 3)
    ELSE substr(name, 1, {spot} + 1) || substr(name, {spot} + 1) END AS term
FROM events JOIN (VALUES {values}) AS v(i, name) ON event_id % {len(names)} = i
"""


MISSPELT_DIAGNOSES = misspelt(DIAGNOSES, 12)
# breeds also appear inside a longer text or with their words turned round
MISSPELT_BREEDS = f"""
SELECT record_id, CASE record_id % 5
    WHEN 0 THEN 'a very friendly ' || term || ' crossbreed'
    WHEN 1 THEN lower(term)
    WHEN 2 THEN term || ' dog ' || term
    ELSE term END AS term
FROM ({misspelt(BREEDS, 3)}) AS m
"""
# part names with their words turned round and a letter missing
MISSPELT_PARTS = """
SELECT p_partkey AS record_id,
  CASE p_partkey % 3
    WHEN 0 THEN substr(p_name, strpos(p_name, ' ') + 1) || ' ' || substr(p_name, 1, strpos(p_name, ' ') - 1)
    WHEN 1 THEN substr(p_name, 1, 2) || substr(p_name, 4)
    ELSE 'one ' || p_name || ' in a large box' END AS term
FROM part
""".replace("strpos(", "instr(")

# Names of one to six words from the given tables, one of which stands inside another, and some that end in a bracket.
GAZETTEER = """
SELECT c_name AS name, 'ORG' AS label FROM customer
UNION ALL SELECT 'Clinic ' || CAST(c_custkey AS STRING) || ' of the ' || p_name, 'ORG' FROM customer
  JOIN part ON p_partkey = c_custkey % 200
UNION ALL SELECT DISTINCT p_name, 'LOC' FROM part
UNION ALL SELECT 'Clinic', 'GPE'
UNION ALL SELECT 'Vet (' || CAST(c_custkey AS STRING) || ')', 'ORG' FROM customer
"""
# Notes with such names, a title, a placeholder, and a name that a letter beyond ASCII runs into.
NAMED_NOTES = """
SELECT event_id AS record_id, c_name, p_name, 'Clinic ' || CAST(c_custkey AS STRING) || ' of the ' || p_name AS clinic,
  'Vet (' || CAST(c_custkey AS STRING) || ')' AS vet,
  'Dr Hale saw ' || c_name || ' at Clinic ' || CAST(c_custkey AS STRING) || ' of the ' || p_name
    || ', not [LOCATION_1] nor Clinic and ' || CASE event_id % 2 WHEN 0 THEN 'é' ELSE 'e' END || p_name || '. ' || p_name
    || ' via Vet (' || CAST(c_custkey AS STRING) || '), not xVet (' || CAST(c_custkey AS STRING) || ')' AS raw_text
FROM events JOIN customer ON c_custkey = event_id % 150
  JOIN part ON p_partkey = c_custkey % 200
"""

# A span table as a model would give it: the words of each note under labels in turn.
GIVEN_LABELS = ["PERSON", "ORG", "GPE", "LOC", "DATE", "CARDINAL"]
WORDS = "[A-Za-z0-9/+@.]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that a task of costly work on rows takes at most.
TASK_ROWS = 100_000


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Give every core a part, and no part more than ``TASK_ROWS`` rows on average, before costly work on the rows.

    The cost is in the rows, not in their bytes: a split of a narrow table holds millions of them.  Input that has
    enough splits is left alone: no shuffle.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.repartition(parts, key) if rows.rdd.getNumPartitions() < parts else rows


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(record_id, raw_text, disease, gold, icd)``"""
    return spark.sql(NOTES.replace("FROM events", "FROM {events}"), events=events(spark, sf_dir))


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = SOURCE.replace("{", "{{").replace("}", "}}").replace("FROM notes", "FROM {notes}")
    return spark.sql(sql, notes=notes(spark, sf_dir))


def misspelt_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MISSPELT_DIAGNOSES.replace("FROM events", "FROM {events}"), events=events(spark, sf_dir))


def misspelt_breeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MISSPELT_BREEDS.replace("FROM events", "FROM {events}"), events=events(spark, sf_dir))


def misspelt_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MISSPELT_PARTS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))


def _from_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = ("events", "customer", "part")
    for name in names:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(sql, **{name: events(spark, sf_dir) if name == "events" else table(spark, sf_dir, name) for name in names})


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, GAZETTEER)


def named_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(record_id, raw_text)``, dealt by record: the joins leave the notes in as few parts as there are customers in them."""
    parts = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "events").count() // TASK_ROWS))
    return _from_tables(spark, sf_dir, NAMED_NOTES).select("record_id", "raw_text").repartition(parts, "record_id")


def spans_of(notes: DataFrame) -> DataFrame:
    """Annotated diagnoses as ``(record_id, ord, entity)``."""
    return notes.filter("disease IS NOT NULL").select("record_id", F.lit(0).alias("ord"), F.col("disease").alias("entity"))


def annotated(notes: DataFrame) -> DataFrame:
    """Notes with ``icd_labels``, ``disease_spans`` and ``gold`` as arrays."""
    none = F.array().cast("array<string>")
    return notes.select(
        "record_id",
        "raw_text",
        F.when(F.col("icd") == "", none).otherwise(F.array("icd")).alias("icd_labels"),
        F.when(F.col("disease").isNull(), none).otherwise(F.array("disease")).alias("disease_spans"),
        F.when(F.col("gold") == "", none).otherwise(F.split("gold", "[|]")).alias("gold"),
    )


def given_spans(notes: DataFrame) -> DataFrame:
    """``(record_id, ord, text, label)`` of every word."""
    words = notes.select("record_id", F.posexplode(F.regexp_extract_all("raw_text", F.lit(WORDS), F.lit(0))).alias("ord", "text"))
    names = F.array(*map(F.lit, GIVEN_LABELS))
    label = F.get(names, F.pmod(F.col("record_id") + F.col("ord"), F.lit(len(GIVEN_LABELS))).cast("int"))
    return words.select("record_id", "ord", "text", label.alias("label"))
