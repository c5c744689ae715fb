"""Queries of this package that SQL can express, next to their SQL."""

import os
import sys

import pytest
from fixtures import SF

from shardweave.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from check_oracles import compare, duck  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    problem, n, _ = compare(spark, duck(SF), name, SF, QUERIES, ORACLES)
    assert problem is None and n > 0
