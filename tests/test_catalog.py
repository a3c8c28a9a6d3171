"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check import connect, differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    problem = differences(spark, duck, FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem in (None, "no rows")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["domain", "unique_urls", "share_pct", "cum_share_pct"]
