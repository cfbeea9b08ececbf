"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import workload.queries  # noqa: E402
from workload.compare import connect, difference  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
OWN = sorted(set(ORACLES) & set(workload.queries.QUERIES))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(workload.queries.QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert difference(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
