"""Queries that SQL can express, against DuckDB."""

import pytest

import compare
from passagework.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    found = compare.differences(queries.QUERIES[name](spark, sf_dir), compare.connect(sf_dir), queries.ORACLES[name])
    assert found is None
