"""Every registered query with an SQL twin gives the twin's rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.parity import compare, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_one_row_per_session(spark):
    df = entry.entry(spark)
    assert df.count() == df.select("sid").distinct().count() > 0
