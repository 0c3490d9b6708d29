"""Every registered query against its SQL counterpart."""

import pytest

import compare
import __spark_entry__ as entry_points
from workload import oracles as workload_oracles, queries as workload_queries

QUERIES = workload_queries.QUERIES
ORACLES = workload_oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


# Random projections are beyond SQL: tests/test_lsh.py holds them against the exact search.
WITHOUT_SQL = {"topk_lsh"}


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert sorted(r["k"] for r in rows) == [1, 3, 5, 10]
    assert all(0 <= r["recall"] <= 1 for r in rows)
