"""Nested blocks are built behind one exchange of bare values."""

import os

import pytest

from chainfold.queries import rules

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def test_one_exchange(spark):
    plan = rules.nested_blocks(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan
