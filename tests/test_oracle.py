"""Every registered query against its DuckDB twin (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare
from wideflow.plans.registry import REGISTRY

SQL = {name: sql for name, (_fn, sql) in REGISTRY.items() if sql is not None}
QUERIES = {name: fn for name, (fn, _sql) in REGISTRY.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], duck_small)
    assert r["ok"], r


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark, duck_small):
    df = E.entry(spark)
    assert df.count() == len(duck_small.execute(SQL["header_keyed"]).fetchall()) > 500
    assert df.columns[0] == "row_key"


def test_entry_registers_all_queries():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
