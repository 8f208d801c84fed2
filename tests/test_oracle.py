"""Every registered query with SQL text must equal its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from tripsight.plans.compare import compare, duck

SF = "/root/testdata/sf0.001"
CHECKED = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "mean_fare" in df.columns
