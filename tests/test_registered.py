"""Every registered query with an SQL twin gives the twin's rows on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, spark_side, sql_side

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    assert spark_side(entry.queries()[name](spark, SF_DIR)) == sql_side(con, ORACLE[name])


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_flagship_runs(spark):
    out = entry.entry(spark)
    assert out.columns == ["epic_status", "mean_trust"]
    assert 0 < out.count() <= 4
