"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, database  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

pytestmark = pytest.mark.skipif(
    not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not there"
)


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, sf, name):
    verdict, n = compare(spark, con, sf, name)
    assert verdict in ("ok", "rows only") and n > 0


def test_entry(spark):
    assert entry(spark).count() > 0
