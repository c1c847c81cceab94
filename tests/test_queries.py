"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from workload import oracles, queries as workload_queries
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registries_match():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(workload_queries.queries()) - set(oracles.oracle_sql()) == {"layout_stats"}


@pytest.mark.parametrize("name", sorted(workload_queries.queries()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name).startswith(("ok", "rows only"))


def test_entry_runs(spark):
    frame = spark_entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[0] == "pickup_date"
