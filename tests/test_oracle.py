"""The correctness gate: every registered query equals its SQL twin (DuckDB) on sf0.001."""

import re

import pytest
from conftest import ROOT, SF_SMALL

import __spark_entry__ as E
from oracle_compare import compare, duck

def _own(found):
    """Without the training-data queries, which have their own tests."""
    return {k: v for k, v in found.items() if not re.match(r"op\d+_|pipeline$", k)}


QUERIES = _own(E.queries())
SQL = _own(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, report = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, report


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
