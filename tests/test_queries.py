"""Every query against its SQL on the smallest tables; queries without SQL give rows of a stable schema."""

from __future__ import annotations

import pytest

from tests.oracle import both, connect
from weft.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, con, name):
    got, want = both(catalog.QUERIES[name](spark, SF), con, catalog.SQL[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert all(len(r) == len(df.columns) for r in rows)


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
