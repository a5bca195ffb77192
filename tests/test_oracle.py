"""Registered queries against their literal-SQL oracles on the smallest scale."""

import pytest

import oracle
from conftest import SF_SMALL

import __spark_entry__ as E

# Every query of the feature store that has an oracle; the others train models
# and are exercised in test_ml_stream.py.
KEYS = sorted(E.catalog.ORACLE)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = oracle.compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "id" in df.columns and len(df.columns) == 3 + 172 + 3
    assert df.count() > 0
