"""Driver contract and oracle parity for every registered query."""

import pytest

import __spark_entry__ as entry
from harness import compare, duck

from conftest import SF001

SQL = entry.oracle_sql()
KEYS = sorted(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "vwap" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(KEYS) - set(SQL)
    assert all(k == "pipeline" or k.startswith("op") for k in rows_only)
    assert set(SQL) <= set(KEYS)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", [k for k in KEYS if k in SQL])
def test_oracle_parity_sf0001(spark, con, key):
    got = entry.queries()[key](spark, SF001).toPandas()
    want = con.execute(SQL[key]).df()
    ok, msg = compare(got, want)
    assert ok, msg
