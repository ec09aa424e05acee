"""Every registered query equals its DuckDB oracle SQL on the smallest tables."""

import pytest

from varpair.plans.oracle_check import compare, duck
from varpair.plans.registry import ORACLE, QUERIES, load_all

from .conftest import SF_SMALL

load_all()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(NAMES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, con)
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r
