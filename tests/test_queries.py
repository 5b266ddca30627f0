"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.check_queries import connect, differences

ORACLES = {name: sql for area in entry.AREAS for name, sql in area.oracles().items()}
QUERIES = {name: query for name, query in entry.queries().items() if name in ORACLES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert {name for area in entry.AREAS for name in area.QUERIES} == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    built = []

    def query(*given):
        built.append(QUERIES[name](*given))
        return built[0]

    assert differences(spark, con, query, ORACLES[name], sf_dir) is None
    # a round-robin exchange would move whole tables whenever there are few input splits
    assert "RoundRobinPartitioning" not in built[0]._jdf.queryExecution().executedPlan().toString()


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
