"""Every registered job against its DuckDB oracle text on sf0.001."""
import re

import pytest

import __spark_entry__ as entry
from tools.compare import compare, duck

from conftest import SMALL

# The training-data queries have tests of their own.
QUERIES = {k: f for k, f in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_oracle_or_is_documented():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "TotalFlights" in df.columns
