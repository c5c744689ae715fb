"""Every registered query against its SQL, on the smallest scale factor."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = dict(entry.QUERIES), dict(entry.ORACLES)  # those of subpackage llm have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem, n, _ = compare(spark, con, name, SF_DIR, QUERIES, ORACLES)
    assert problem is None
    assert n > 0
