"""Every registered query against its DuckDB oracle text on the smallest
driver data set (the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SF = os.environ.get("STARLOOM_TEST_SF", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from starloom.plans.queries import QUERIES as WAREHOUSE

    assert set(WAREHOUSE) <= set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("op") and n != "pipeline"))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["ok"], r.get("why")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "average_order_value" in df.columns
