"""Every registered query against its oracle statement."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from oracles.sql import statements
from siltstone.plans import catalog

QUERIES, ORACLES = catalog.registered(), statements()


@pytest.fixture(scope="module")
def found(spark, folder):
    con = duck(folder)

    def check(name):
        try:
            return name, differences(QUERIES[name](spark, folder), con.cursor(), ORACLES[name])
        except Exception as error:  # reported by the test of that query
            return name, f"{type(error).__name__}: {str(error)[:500]}"

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(pool.map(check, QUERIES))


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys() and QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(found, name):
    assert found[name] is None, found[name]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_title", "date_sort", "amount"] and df.count() > 0
