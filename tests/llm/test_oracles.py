"""Queries with a DuckDB statement against it."""

from __future__ import annotations

import pytest

from stationcast.llm import queries
from tests import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, small, name):
    assert compare.differences(queries.QUERIES[name](spark, small), compare.duck(small),
                               queries.ORACLES[name]) == []


def test_names(spark):
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and set(queries.ORACLES) <= set(queries.QUERIES)
