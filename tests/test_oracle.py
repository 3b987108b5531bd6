"""Every registered query against its DuckDB oracle (exact match, sorted column names, types)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck_conn

from marketlake.plans.registry import QUERIES as LIBRARY

QUERIES = {k: v for k, v in entry.queries().items() if k in LIBRARY or k in entry.oracle_sql()}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(LIBRARY) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r.get("columns_match"), r
    assert r.get("types_match"), r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r.get("exact"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "receita_total" in df.columns
