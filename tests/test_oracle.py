"""Every registered query against its SQL counterpart."""

import importlib
from pathlib import Path

import pytest

import compare

from noteloom.plans import oracles
from noteloom.plans import queries as registry

entry = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = registry.registered(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(Path(sf_dir))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert compare.difference(spark, duck, QUERIES[name], ORACLES[name], Path(sf_dir)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
