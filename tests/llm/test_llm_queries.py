"""Registered pipeline queries against their SQL in DuckDB."""

import pytest

from almanac.llm.queries import ORACLES, QUERIES
from workload.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name]) is None
