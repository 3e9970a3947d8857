"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import oracle
from chainfold.queries import collection

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(collection.QUERIES))
def test_query_equals_sql(spark, db, name):
    ok, text = oracle.compare(spark, db, name, collection.QUERIES[name], collection.SQL.get(name), FOLDER)
    assert ok, text


def test_entry(spark):
    import __spark_entry__ as E
    assert E.entry(spark).columns == ["address", "slot", "value"]
    assert set(E.oracle_sql()) <= set(E.queries())
