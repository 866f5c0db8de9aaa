"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from restock.plans.oracle import ORACLE
from restock.plans.registry import queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

KEYS = sorted(queries())


def test_every_query_has_oracle():
    assert set(ORACLE) == set(queries())
    assert set(queries()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    r = compare(df, con, ORACLE[key])
    assert r["cols_match"], r
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "action_" in df.columns
