"""Every registered key against its DuckDB oracle on the smallest driver tables (the driver gate at sf0.01)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

# The training-data operators have their own tests (tests/llm).
KEYS = [k for k in E.queries() if not re.match(r"op\d+_|pipeline", k)]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    res = compare(spark, SF_SMALL, key, E.queries()[key], E.oracle_sql().get(key), con)
    assert res["status"] == "exact", res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "product_count" in df.columns
