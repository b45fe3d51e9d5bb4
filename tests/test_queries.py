"""Every registered query against its SQL, whole results."""

import re

import pytest

import __spark_entry__ as contract
from compare import compare, database

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return database(small)


# Queries of the language-model package are tested beside it.
OWN = sorted(n for n in QUERIES if n != "pipeline" and not re.match(r"op\d+_", n))


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, small, db, name):
    problems, _ = compare(QUERIES[name](spark, small), db, SQL[name])
    assert not problems


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 2
