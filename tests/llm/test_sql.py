"""Corpus queries with SQL equal DuckDB on the smallest tables."""

import collections

import pytest

from varpair.llm.queries import ORACLE, QUERIES
from varpair.plans.oracle_check import canon, duck

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ["op6_jaccard_join", "op7_phrase_dedup", "op8_suffix_dedup"])
def test_query_equals_sql(spark, con, name):
    found = QUERIES[name](spark, SF_SMALL)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    want = canon(columns, want.fetchall())
    got = canon(found.columns, [tuple(r) for r in found.collect()])
    assert got[0] == want[0] and collections.Counter(got[1]) == collections.Counter(want[1])
    assert len(set(got[1])) > 100
