"""Every registered query equals its DuckDB twin (row multiset, column names)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from wellspark.plans.catalog import QUERIES
from wellspark.plans.sql_twins import TWINS


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_contract_shapes():
    qs = E.queries()
    assert set(TWINS) <= set(qs)
    assert len(qs) >= 70
    # every query of the catalog has a twin (the optional training-data queries have tests of their own)
    assert set(QUERIES) == set(TWINS) and set(E.oracle_sql()) <= set(qs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert df.columns[:2] == ["employee_id", "eligibility_status"]


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, E.queries()[name], TWINS[name])
    assert r["ok"], r
