"""Every registered query with oracle SQL equals DuckDB at sf0.01 (the correctness gate)."""

import pytest

import __spark_entry__ as E
from newslab.plans.queries import REGISTRY
from tests.oracle_check import compare, duck

from .conftest import SF01

# The training-data operators have their own tests.
KEYS = sorted(set(E.oracle_sql()) & set(REGISTRY))


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF01)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"label", "documents", "total_words"}


def test_every_key_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
