"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task takes at most; a key with more is dealt to as many places as it needs.
TARGET_ROWS = 1_000_000


def heavy_keys(counts: DataFrame, keys: list[str], count: str, target: int = TARGET_ROWS) -> DataFrame:
    """``(_hash, _places)`` of the keys with more than ``target`` rows, from a table with one row per key.

    There are at most rows / ``target`` of them, twelve bytes each.
    """
    heavy = counts.filter(F.col(count) > target)
    places = F.ceil(F.col(count) / target).cast("int")
    return heavy.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.max(places).alias("_places"))


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], heavy: DataFrame, row_id: str, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``groups`` (one row per key) with the rows of heavy keys spread out.

    Rows of a heavy key go to one of its places by a hash of ``row_id`` and the one group
    row of that key is copied to all of them; other keys join as usual.  NULL keys match NULL.
    Both sides look a key up by its hash, so a key that shares one is merely dealt out too.
    The place depends on the row alone, so a task that runs again gives the same rows.
    """

    def mark(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(heavy), F.xxhash64(*keys) == F.col("_hash"), "left").drop("_hash")

    place = F.when(F.col("_places").isNull(), 0).otherwise(F.pmod(F.xxhash64(row_id), F.col("_places")).cast("int"))
    left = mark(rows).withColumn("_salt", place).drop("_places")
    everywhere = F.sequence(F.lit(0), F.coalesce("_places", F.lit(1)) - 1)
    right = mark(groups).withColumn("_g_salt", F.explode(everywhere)).drop("_places").withColumnsRenamed({k: f"_g_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys] + [F.col("_salt") == F.col("_g_salt")]
    return left.join(right, reduce(and_, match), how).drop("_salt", "_g_salt", *[f"_g_{k}" for k in keys])


# Rows of one key and side that a cell of a join takes.
CELL_ROWS = 4096


def dealt_join(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, how: str = "left", cell: int = CELL_ROWS) -> DataFrame:
    """Join many rows to many on ``key``, with the pairs of heavy keys dealt to cells.

    A key with more than ``cell`` rows on either side becomes a grid: each row goes to one line of it by a hash of its id, and is copied to
    all cells of that line, so no task gets more than ``cell`` times ``cell`` pairs of a key at once.  Heavy keys are at most
    (rows of both sides) / ``cell``, sixteen bytes each, and known by exact counts.  A left row may be met several times without
    a partner if ``how`` is left.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("_nl")).join(right.groupBy(key).agg(F.count("*").alias("_nr")), key)
    heavy = counts.filter((F.col("_nl") > cell) | (F.col("_nr") > cell)).select(
        F.col(key).alias("_heavy"), *[F.ceil(F.col(n) / cell).cast("int").alias(p) for n, p in (("_nl", "_pl"), ("_nr", "_pr"))]
    )

    def mark(df: DataFrame, own: str, other: str, row_id: str, names: tuple[str, str]) -> DataFrame:
        marked = df.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left").drop("_heavy")
        line = F.coalesce(F.pmod(F.xxhash64(row_id), F.col(own)).cast("int"), F.lit(0)).alias(names[0])
        cells = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)).alias(names[1])
        return marked.select(*df.columns, line, cells)

    on = ["_line", "_column"]
    rows, others = mark(left, "_pl", "_pr", left_id, ("_line", "_column")), mark(right, "_pr", "_pl", right_id, ("_column", "_line"))
    return rows.join(others, [key, *on], how).drop(*on)
