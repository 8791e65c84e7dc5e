"""k-anonymity over the quasi-identifiers age, weight and sex."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteloom.functions.patterns import CLINICAL_PATTERNS
from noteloom.functions.text import all_matches, col, first_match, first_number, let, to_number
from noteloom.operators.extract import first_of
from noteloom.operators.skew import heavy_keys, salted_join

QUASI_KEYS = ["age", "weight", "sex"]
UNKNOWN = "unknown"
VALUE_LISTS = {"age_values": "age", "weight_values": "weight"}


def quasi_keys(notes: DataFrame, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """``(key, age, weight, sex)``: the first match of each, ``unknown`` where there is none."""
    patterns = {"age": "age", "weight": "weight", "sex": "sex_neuter"}
    return notes.select(
        key, *[F.coalesce(F.expr(first_of(col(text), p)), F.lit(UNKNOWN)).alias(c) for c, p in patterns.items()]
    )


def k_groups(keyed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key combination with its number of records."""
    return keyed.groupBy(*(keys or QUASI_KEYS)).agg(F.count("*").alias("n_records"))


def k_anonymity(groups: DataFrame, k: int = 5) -> DataFrame:
    """Add ``risky``: fewer than ``k`` records share the combination."""
    return groups.withColumn("risky", F.col("n_records") < k)


def k_summary(groups: DataFrame, k: int = 5) -> DataFrame:
    """One row: number of groups, of risky groups, of records and of records at risk."""
    risky = F.col("n_records") < k
    return groups.agg(
        F.count("*").alias("n_groups"),
        F.count_if(risky).alias("risky_groups"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"),
        F.coalesce(F.sum(F.when(risky, F.col("n_records"))), F.lit(0)).alias("records_at_risk"),
    )


def k_members(keyed: DataFrame, k: int = 5, keys: list[str] | None = None, key: str = "record_id") -> DataFrame:
    """Each record with its group's ``n_records`` and ``risky``; very common combinations are salted."""
    keys = keys or QUASI_KEYS
    groups = k_groups(keyed, keys)
    return salted_join(keyed, k_anonymity(groups, k), keys, heavy_keys(groups, keys, "n_records"), key)


def generalise_age(age: str) -> Column:
    """Age band of an age text column (bands and limits are fixed values); months and weeks are juvenile whatever the number."""
    text = f"lower({age})"
    cases = f"""CASE WHEN ga_n IS NULL THEN '{UNKNOWN}'
      WHEN contains({text}, 'month') OR contains({text}, 'wk') OR contains({text}, 'week') THEN 'juvenile'
      WHEN ga_n <= 2 THEN '0-2 years' WHEN ga_n <= 5 THEN '3-5 years' WHEN ga_n <= 10 THEN '6-10 years'
      ELSE '11+ years' END"""
    return F.expr(let("ga_n", let("ga_d", first_match(age, r"\d+"), to_number("ga_d")), cases))


def generalise_weight(weight: str) -> Column:
    """Weight band of a weight text column by its number alone (bands and limits are fixed values)."""
    cases = f"""CASE WHEN gw_n IS NULL THEN '{UNKNOWN}' WHEN gw_n < 5 THEN '0-5kg' WHEN gw_n < 10 THEN '5-10kg'
      WHEN gw_n < 20 THEN '10-20kg' WHEN gw_n < 40 THEN '20-40kg' ELSE '40+kg' END"""
    return F.expr(let("gw_n", first_number(weight), cases))


GENERALISERS = {"age": generalise_age, "weight": generalise_weight}


def generalise(keyed: DataFrame, condition: Column, rules: dict | None = None) -> DataFrame:
    """Generalise the columns named in ``rules`` (column name to expression) where ``condition`` holds; absent values stay absent."""
    rules = GENERALISERS if rules is None else rules
    return keyed.select(
        *[
            F.when(condition & (F.col(c) != UNKNOWN), rules[c](c)).otherwise(F.col(c)).alias(c)
            if c in rules
            else F.col(c)
            for c in keyed.columns
        ]
    )


def mitigate(keyed: DataFrame, k: int = 5, keys: list[str] | None = None, rules: dict | None = None, key: str = "record_id") -> DataFrame:
    """Records with the keys of risky groups generalised once; adds ``n_records`` and ``risky``."""
    return generalise(k_members(keyed, k, keys, key), F.col("risky"), rules)


def mitigated_groups(groups: DataFrame, k: int = 5, keys: list[str] | None = None, rules: dict | None = None) -> DataFrame:
    """The group table after mitigation, from the group table before: records need no second pass."""
    after = generalise(k_anonymity(groups, k), F.col("risky"), rules)
    return after.groupBy(*(keys or QUASI_KEYS)).agg(F.sum("n_records").alias("n_records"))


def k_before_after(keyed: DataFrame, k: int = 5, keys: list[str] | None = None, rules: dict | None = None) -> DataFrame:
    """Summaries before and after mitigation."""
    groups = k_groups(keyed, keys)
    before = k_summary(groups, k).withColumn("stage", F.lit("before"))
    after = k_summary(mitigated_groups(groups, k, keys, rules), k).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


def mitigated_patterns(notes: DataFrame, k: int = 5, text: str = "raw_text", key: str = "record_id") -> DataFrame:
    """``(key, age_values, weight_values, sex, n_records, risky)`` with the pattern lists of each note.

    A record at risk keeps one generalised value in each list it has; other lists stay whole.
    """
    found = notes.select(
        key,
        *[F.expr(all_matches(col(text), CLINICAL_PATTERNS[p], ignore_case=True)).alias(c) for c, p in VALUE_LISTS.items()],
        F.coalesce(F.expr(first_of(col(text), "sex_neuter")), F.lit(UNKNOWN)).alias("sex"),
    )
    return mitigated_lists(keyed_lists(found), k, key)


def keyed_lists(found: DataFrame) -> DataFrame:
    """Add ``age`` and ``weight``, the first of each list, to ``(key, age_values, weight_values, sex)``."""
    return found.select("*", *[F.coalesce(F.get(c, F.lit(0)), F.lit(UNKNOWN)).alias(p) for c, p in VALUE_LISTS.items()])


def extracted_lists(extracted: DataFrame, key: str = "record_id") -> DataFrame:
    """``(key, age_values, weight_values, sex, age, weight)`` from written extractions: no text is matched again."""
    none = F.array().cast("array<string>")

    def matches(pattern: str) -> Column:
        return F.coalesce(F.try_element_at("extracted.vet_patterns", F.lit(pattern)), none)

    sex = F.coalesce(F.get(matches("sex_neuter"), F.lit(0)), F.lit(UNKNOWN)).alias("sex")
    return keyed_lists(extracted.select(key, *[matches(p).alias(c) for c, p in VALUE_LISTS.items()], sex))


def mitigated_lists(keyed: DataFrame, k: int = 5, key: str = "record_id") -> DataFrame:
    """The lists of :func:`keyed_lists` with the values of records at risk generalised."""
    members = k_members(keyed, k, key=key)
    return members.select(
        key,
        *[
            F.when(F.col("risky") & (F.size(c) > 0), F.array(GENERALISERS[p](p))).otherwise(F.col(c)).alias(c)
            for c, p in VALUE_LISTS.items()
        ],
        "sex",
        "n_records",
        "risky",
    )
