"""Compare registered queries with their SQL counterparts: ``python tests/compare.py sf0.01 [names]``."""

from __future__ import annotations

import importlib
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata")


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(sf_dir.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 5) + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(types: dict[str, str]) -> dict[str, str]:
    same = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}
    return {c: same.get(t, t) for c, t in types.items()}


def difference(spark, con, query, sql: str, sf_dir: Path) -> str | None:
    """What differs between a query and its SQL, None if nothing does."""
    frame = query(spark, str(sf_dir))
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = kinds({d[0]: str(d[1]) for d in result.description})
    expected = rows_of(columns, result.fetchall())
    if dict(frame.dtypes) != types:
        return f"schema {dict(frame.dtypes)} != {types}"
    got = rows_of(frame.columns, frame.collect())
    if got != expected:
        only_got, only_expected = list((got - expected).items())[:4], list((expected - got).items())[:4]
        return f"rows {got.total()} != {expected.total()}: got {only_got} expected {only_expected}"
    return None


def main(scale: str, names: list[str]) -> int:
    from noteloom.session import local_session

    entry = importlib.import_module("__spark_entry__")
    spark, con = local_session(8), connect(DATA / scale)
    oracles, failed = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, query, oracles[name], DATA / scale) if name in oracles else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:30s} {time.time() - start:6.1f}s {'ok' if problem is None else problem}", flush=True)
        failed += [name] if problem not in (None, "no SQL") else []
    print(f"{len(failed)} differ: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "sf0.001", sys.argv[2:]))
