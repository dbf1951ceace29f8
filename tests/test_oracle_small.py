"""Every registered query with a DuckDB twin, at the smallest scale."""

import pytest

import __spark_entry__ as se
import oracle_compare as oc
from conftest import SF_SMALL

NAMES = sorted(se.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return oc.duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    got = oc.spark_digest(df)
    want = oc.duck_digest(con, se.oracle_sql()[name])
    assert got[1] == want[1], "columns differ"
    assert got[0] == want[0], "row counts differ"
    assert got[2] == want[2], oc.first_diff(df, con, se.oracle_sql()[name])


def test_every_query_has_a_callable():
    assert set(se.oracle_sql()) <= set(se.queries())
