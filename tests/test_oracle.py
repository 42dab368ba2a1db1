"""Every registered query equals its DuckDB oracle exactly (sf0.001)."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from tripmart.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    res = compare(spark, SF_SMALL, name, fn, sql, con)
    assert res["ok"], res


def test_every_query_has_an_oracle():
    missing = [n for n, (_, sql) in REGISTRY.items() if sql is None]
    assert missing == []


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0
    assert "date_key" in df.columns
